"""Narrative analytics on Spark: segmentation, annotation layers, relations and story graphs over many documents in one job."""
