"""Genotype-shaped views over the star-schema and text tables, in Spark and as SQL for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_SAMPLES = 60
LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "acgtacgtacgtacgtacgtacgtac"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calls(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """(sample, tag, phase, hash, known); 200 tags, or if ``wide`` as many as there are parts, about a call for each line."""
    tag = F.col("l_partkey") if wide else F.col("l_partkey") % 200
    hash_ = F.max(F.concat("l_returnflag", "l_linestatus", (F.col("l_quantity").cast("int") % 3).cast("string")))
    rows = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % N_SAMPLES).alias("sample"), tag.alias("tag"), (F.col("l_linenumber") % 2).alias("phase")).agg(hash_.alias("hash"))
    return rows.withColumn("known", ~F.col("hash").endswith("0"))


def ref_tiles(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """(tag, seqname, step, hash, len, bases)"""
    rows = calls(spark, sf_dir, wide).groupBy("tag").agg(F.min("hash").alias("hash"))
    length = (148 + (F.col("tag") % 7) * 10).cast("long")
    return rows.select("tag", F.concat(F.lit("chr"), (F.floor(F.col("tag") / 50) + 1).cast("string")).alias("seqname"), F.col("tag").alias("step"), "hash", length.alias("len"), (length - F.col("tag") % 5).alias("bases"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, is_case, is_training)"""
    return spark.range(N_SAMPLES).select(F.col("id").alias("sample"), (F.col("id") % 2 == 1).alias("is_case"), (F.col("id") % 5 != 0).alias("is_training"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("p_partkey") * 53 % 100_000
    return table(spark, sf_dir, "part").select(F.concat(F.lit("chr"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("seqname"), start.alias("start"), (start + F.col("p_size")).alias("end"))


def to_bases(text):
    return F.regexp_replace(F.translate(F.lower(text), LETTERS, BASES), "[^acgt]", "n")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", to_bases(F.col("text")).alias("seq"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tag, tagseq): the distinct first six bases of the benchmark's texts."""
    from pyspark.sql import Window

    heads = table(spark, sf_dir, "benchmark").select(F.substring(to_bases(F.col("text")), 1, 6).alias("tagseq")).where("tagseq not like '%n%' and length(tagseq) = 6").distinct()
    return heads.select((F.row_number().over(Window.orderBy("tagseq")) - 1).cast("long").alias("tag"), "tagseq")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seqname, start, end, called) of gVCF-like blocks."""
    start = F.col("event_id") * 2
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("seqname"), start.alias("start"), (start + 1 + F.col("event_id") % 5).alias("end"), (F.col("value") >= 50).alias("called"))


#: The same views as common table expressions.
SQL = {
    "calls": "calls AS (SELECT l_orderkey % 60 AS sample, l_partkey % 200 AS tag, l_linenumber % 2 AS phase, max(l_returnflag || l_linestatus || (trunc(l_quantity)::INT % 3)::VARCHAR) AS hash, max(l_returnflag || l_linestatus || (trunc(l_quantity)::INT % 3)::VARCHAR) NOT LIKE '%0' AS known FROM lineitem GROUP BY 1, 2, 3)",
    "ref": "ref AS (SELECT tag, 'chr' || (tag // 50 + 1)::VARCHAR AS seqname, tag AS step, min(hash) AS hash, 148 + (tag % 7) * 10 AS len, 148 + (tag % 7) * 10 - tag % 5 AS bases FROM calls GROUP BY tag)",
    "placed": "placed AS (SELECT *, coalesce(sum(len - 24) OVER (PARTITION BY seqname ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM ref)",
    "samples": "samples AS (SELECT i AS sample, i % 2 = 1 AS is_case, i % 5 <> 0 AS is_training FROM range(60) t(i))",
    "counts": "counts AS (SELECT tag, hash, sum(n)::BIGINT AS n FROM (SELECT tag, hash, count(*) AS n FROM calls WHERE known GROUP BY 1, 2 UNION ALL SELECT DISTINCT tag, hash, 0 FROM ref) GROUP BY 1, 2)",
    "ranked": "ranked AS (SELECT tag, hash, n, row_number() OVER (PARTITION BY tag ORDER BY n DESC, hash) AS variant FROM counts)",
    "numbered": "numbered AS (SELECT c.*, coalesce(r.variant, 0) AS variant FROM calls c LEFT JOIN ranked r USING (tag, hash))",
    "carriers": "carriers AS (SELECT sample, tag, variant, count(*) >= 2 AS hom FROM numbered WHERE known AND variant > 0 GROUP BY 1, 2, 3)",
    "regions": "regions AS (SELECT 'chr' || (p_partkey % 4 + 1)::VARCHAR AS seqname, p_partkey * 53 % 100000 AS \"start\", p_partkey * 53 % 100000 + p_size AS \"end\" FROM part)",
    "spans": "spans AS (SELECT tag, seqname, pos AS \"start\", pos + len AS \"end\" FROM placed)",
    "contigs": f"contigs AS (SELECT doc_id, regexp_replace(translate(lower(text), '{LETTERS}', '{BASES}'), '[^acgt]', 'n', 'g') AS seq FROM documents)",
    "tags": f"tags AS (SELECT row_number() OVER (ORDER BY tagseq) - 1 AS tag, tagseq FROM (SELECT DISTINCT substr(regexp_replace(translate(lower(text), '{LETTERS}', '{BASES}'), '[^acgt]', 'n', 'g'), 1, 6) AS tagseq FROM benchmark) WHERE tagseq NOT LIKE '%n%' AND length(tagseq) = 6)",
    "blocks": "blocks AS (SELECT event_type AS seqname, event_id * 2 AS \"start\", event_id * 2 + 1 + event_id % 5 AS \"end\", value >= 50 AS called FROM events)",
}
ORDER = list(SQL)
NEEDS = {"ref": ["calls"], "placed": ["ref"], "counts": ["calls", "ref"], "ranked": ["counts"], "numbered": ["calls", "ranked"], "carriers": ["numbered"], "spans": ["placed"]}


def chain(nodes: str, depth: int = 17, name: str = "") -> str:
    """Common table expressions (their names begin with ``name``) that end in s0 (grp, i): the places reached from place 1 of each group of ``nodes`` (grp, i,
    nxt) by following nxt. Pointers are doubled, so 2 ** depth steps take 2 * depth joins."""
    j, s = f"{name}j", f"{name}s"
    out = [f"{j}0 AS MATERIALIZED (SELECT grp, i, nxt FROM {nodes} WHERE nxt IS NOT NULL)"]
    out += [f"{j}{k} AS MATERIALIZED (SELECT a.grp, a.i, b.nxt FROM {j}{k - 1} a JOIN {j}{k - 1} b ON a.grp = b.grp AND a.nxt = b.i)" for k in range(1, depth)]
    out.append(f"{s}{depth} AS MATERIALIZED (SELECT grp, i FROM {nodes} WHERE i = 1)")
    out += [f"{s}{k} AS MATERIALIZED (SELECT grp, i FROM {s}{k + 1} UNION ALL SELECT x.grp, y.nxt FROM {s}{k + 1} x JOIN {j}{k} y ON x.grp = y.grp AND x.i = y.i)" for k in range(depth - 1, -1, -1)]
    return ", ".join(out)


def with_views(body: str, *names: str) -> str:
    """``body`` after the views it names and those they need."""
    todo, need = list(names), set()
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo += NEEDS.get(name, [])
    head = ", ".join(SQL[n] for n in ORDER if n in need)
    if not head:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body.lstrip()[15:]}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {head}, {body.lstrip()[5:]}"
    return f"WITH {head} {body}"
