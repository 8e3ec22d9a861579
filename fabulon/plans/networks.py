"""Registered queries of networks of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabulon.operators import graph, joins, network
from fabulon.sources import reports, writers

from .fixture import speakers
from .registry import R, on_ann, register


def links(a: DataFrame) -> DataFrame:
    """Clusters linked with themes, in some rows."""
    return a.filter("sw = 0").select("doc_id", F.col("cl").alias("a"), F.col("t1").alias("b"))


def named(a: DataFrame) -> DataFrame:
    return a.select("doc_id", "idx", F.explode(F.array("cl", "t1", "t2")).alias("who"))


GROUPS = (
    ", lk AS (SELECT DISTINCT doc_id, cl AS a, t1 AS b FROM ann WHERE sw = 0), bo AS (SELECT * FROM lk UNION ALL SELECT doc_id, b, a FROM lk), re AS (SELECT doc_id, a, b FROM bo UNION SELECT re.doc_id, re.a, bo.b FROM re JOIN bo ON re.doc_id = bo.doc_id AND re.b = bo.a), "
    "gr AS (SELECT doc_id, a AS name, min(b) AS component FROM re GROUP BY 1, 2)"
)
register("net_components", on_ann(lambda a: network.components(links(a))), f"{GROUPS} SELECT * FROM gr", recursive=True)
register(
    "net_canonical",
    on_ann(lambda a: network.canonical(network.components(links(a)), named(a))),
    f"{GROUPS}, me AS (SELECT doc_id, who, count(*) AS n, min(idx) AS f FROM (SELECT doc_id, idx, unnest([cl, t1, t2]) AS who FROM ann) GROUP BY 1, 2), rk AS (SELECT gr.*, row_number() OVER (PARTITION BY gr.doc_id, component ORDER BY coalesce(n, 0) DESC, f, name) AS r FROM gr LEFT JOIN me ON me.doc_id = gr.doc_id AND me.who = gr.name) "
    "SELECT gr.doc_id, gr.name, gr.component, rk.name AS canonical FROM gr JOIN rk ON rk.doc_id = gr.doc_id AND rk.component = gr.component AND r = 1",
    recursive=True,
)


# emotions and dialogues between names of which some hold those of the pairs
def felt(a: DataFrame) -> DataFrame:
    return a.filter("emo_tgt is not null").selectExpr("doc_id", "idx", "concat(if(gap = 1, '', 'x'), s1) as src", "emo_tgt as tgt", "if(gap = 2, '信任', emo) as emo", "emo_int as inten")


def talked(a: DataFrame) -> DataFrame:
    return a.filter("d10 is not null").groupBy("doc_id", F.concat("s1", F.lit("y")).alias("src"), F.col("s2").alias("tgt")).agg(F.count(F.lit(1)).alias("n"))


_told = "CASE " + " ".join(f"WHEN contains(emo, '{k}') THEN '{v}'" for k, v in graph.RELATION_OF.items()) + " END"
_has = lambda x, y: f"(contains({x}, {y}) OR contains({y}, {x}))"
EDGES = (
    ", pa AS (SELECT a.doc_id, a.who AS a, b.who AS b, count(*) AS n FROM spk a JOIN spk b ON a.doc_id = b.doc_id AND a.idx = b.idx AND a.who < b.who GROUP BY 1, 2, 3), "
    "fe AS (SELECT doc_id, idx, concat(CASE WHEN gap = 1 THEN '' ELSE 'x' END, s1) AS src, emo_tgt AS tgt, CASE WHEN gap = 2 THEN '信任' ELSE emo END AS emo, emo_int AS inten FROM ann WHERE emo_tgt IS NOT NULL), ta AS (SELECT doc_id, concat(s1, 'y') AS src, s2 AS tgt, count(*) AS n FROM ann WHERE d10 IS NOT NULL GROUP BY 1, 2, 3), "
    f"fp AS (SELECT pa.doc_id, pa.a, pa.b, count(*) AS k, avg(inten) AS m, arg_min({_told}, idx) FILTER ({_told} IS NOT NULL) AS told FROM pa JOIN fe ON fe.doc_id = pa.doc_id AND ({_has('src', 'a')} AND {_has('tgt', 'b')} OR {_has('src', 'b')} AND {_has('tgt', 'a')}) GROUP BY 1, 2, 3), "
    f"tp AS (SELECT pa.doc_id, pa.a, pa.b, sum(ta.n)::BIGINT AS k FROM pa JOIN ta ON ta.doc_id = pa.doc_id AND ({_has('src', 'a')} AND {_has('tgt', 'b')} OR {_has('src', 'b')} AND {_has('tgt', 'a')}) GROUP BY 1, 2, 3), "
    f"ed AS (SELECT pa.*, coalesce(fp.k, 0) AS n_emotions, coalesce(tp.k, 0) AS n_dialogue, told, {R('least(pa.n / 10, 1) * 0.4::DOUBLE + least(coalesce(m, 0) / 10, 1) * 0.3::DOUBLE + least(coalesce(tp.k, 0) / 5, 1) * 0.3::DOUBLE', 3)} AS strength FROM pa LEFT JOIN fp USING (doc_id, a, b) LEFT JOIN tp USING (doc_id, a, b))"
)
register("net_edges", on_ann(lambda a: network.edges(joins.co_occurrence(speakers(a)), felt(a), talked(a))), f"{EDGES} SELECT doc_id, a, b, n, n_emotions, n_dialogue, strength, CASE WHEN strength < 0.1::DOUBLE THEN '陌生' ELSE coalesce(told, CASE WHEN n_dialogue >= 2 THEN '合作' WHEN n >= 3 THEN '友情' ELSE '陌生' END) END AS relation FROM ed")
register("net_nodes", on_ann(lambda a: network.nodes(named(a))), f", me AS (SELECT doc_id, who, count(*) AS n, count(DISTINCT idx) AS n_segments FROM (SELECT doc_id, idx, unnest([cl, t1, t2]) AS who FROM ann) GROUP BY 1, 2) SELECT *, {R('n / max(n) OVER (PARTITION BY doc_id)', 3)} AS centrality FROM me")

# characters of the derived sentences, known in some segments only
ALIASES = {"张伟": ["张伟", "他"], "王秀英": ["王秀英", "秀英", ""], "李明": ["李明"]}
_al = ", ".join(f"('{w}', '{x}')" for w, xs in ALIASES.items() for x in xs)


def found(a: DataFrame) -> DataFrame:
    docs = a.select("doc_id").distinct()
    listed = lambda name, rows: docs.select("doc_id", F.inline(F.array(*(F.struct(F.lit(w).alias("who"), F.lit(x).alias(name)) for w, x in rows))))
    known = a.filter("gap < 3 and (sent like '%张伟%' or sw = 0)").select("doc_id", "idx", F.when(F.col("sent").contains("张伟"), "张伟").otherwise("李明").alias("who"))
    expected = listed("n_segments", [("张伟", 2), ("王秀英", 1), ("李明", 0)])
    return network.presence(known, expected, listed("alias", [(w, x) for w, xs in ALIASES.items() for x in xs]), a.select("doc_id", "idx", F.col("sent").alias("txt")))


register(
    "jn_alias_fallback",
    on_ann(found),
    f", al(who, alias) AS (VALUES {_al}), ex(who, m) AS (VALUES ('张伟', 2), ('王秀英', 1), ('李明', 0)), kn AS (SELECT doc_id, idx, CASE WHEN contains(sent, '张伟') THEN '张伟' ELSE '李明' END AS who FROM ann WHERE gap < 3 AND (contains(sent, '张伟') OR sw = 0)), "
    "sh AS (SELECT d.doc_id, ex.who FROM (SELECT DISTINCT doc_id FROM ann) d, ex WHERE (SELECT count(*) FROM kn WHERE kn.doc_id = d.doc_id AND kn.who = ex.who) < m) "
    "SELECT doc_id, idx, who FROM kn UNION SELECT ann.doc_id, idx, sh.who FROM ann JOIN sh ON sh.doc_id = ann.doc_id JOIN al ON al.who = sh.who AND al.alias <> '' AND contains(sent, al.alias)",
)


# reports of all documents: their digest, as one row has the whole text
def overview(a: DataFrame) -> DataFrame:
    """A further section: means of each document."""
    n = a.groupBy("doc_id").agg(F.count(F.lit(1)).alias("segments"), F.max("inten").alias("peak"))
    return n.select("doc_id", F.lit("overview").alias("section"), F.posexplode(F.array(F.struct(F.lit("segments").alias("name"), F.col("segments").cast("string").alias("value")), F.struct(F.lit("peak").alias("name"), F.col("peak").cast("string").alias("value")))).alias("rank", "x")).select("doc_id", "section", "rank", "x.name", "x.value")


_one = lambda name, c: f"SELECT doc_id, {list(writers.SECTIONS).index(name)} AS place, '{name}' AS section, {c}::VARCHAR AS value, count(*) AS n, min(idx) AS f FROM ann WHERE {c} IS NOT NULL GROUP BY 1, 4"
REPORT = (
    f", fr AS ({' UNION ALL '.join(_one(k, v) for k, v in writers.SECTIONS.items())}), fk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY n DESC, f, value) AS r FROM fr), "
    "pt AS (SELECT doc_id, place, section, r, value, n::VARCHAR AS note FROM fk WHERE r <= 10 UNION ALL SELECT doc_id, 99, 'overview', 0, 'segments', count(*)::VARCHAR FROM ann GROUP BY 1 UNION ALL SELECT doc_id, 99, 'overview', 1, 'peak', max(inten)::VARCHAR FROM ann GROUP BY 1), "
    "st AS (SELECT doc_id, place, concat(chr(10), '## ', section, chr(10), chr(10), '| value | n |', chr(10), '|-|-|', chr(10), string_agg(concat('| ', value, ' | ', note, ' |', chr(10)), '' ORDER BY r)) AS t FROM pt GROUP BY 1, 2, section), sd AS (SELECT doc_id, string_agg(t, '' ORDER BY place) AS t FROM st GROUP BY 1), "
    "ln AS (SELECT doc_id, count(*) AS n, string_agg(concat('- ', idx, ': ', d01, ', ', emo, ' ', inten, ', ', coalesce(loc, '-'), chr(10)), '' ORDER BY idx) AS t FROM ann GROUP BY 1)"
)
register("report_markdown", on_ann(lambda a: reports.composed(a, overview(a), "markdown").select("doc_id", F.sha2("report", 256).alias("sha256"), F.length("report").cast("long").alias("n_chars"))), f"{REPORT}, rp AS (SELECT ln.doc_id, concat('# Document ', ln.doc_id, chr(10), chr(10), n, ' segments', chr(10), sd.t, chr(10), '## segments', chr(10), chr(10), ln.t) AS t FROM ln JOIN sd ON sd.doc_id = ln.doc_id) SELECT doc_id, sha256(t) AS sha256, length(t)::BIGINT AS n_chars FROM rp")
