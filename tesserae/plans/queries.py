"""Queries: each operator over whole tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import hgvs as H
from tesserae.functions import sequences as Q
from tesserae.functions.statistics import chi2_statistic
from tesserae.operators import annotate, association, export, filters, intervals, library, matrix, pca, reference, samples as people, tiling, variants as vcf
from tesserae.plans import views as V
from tesserae.plans.views import N_SAMPLES, with_views

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, *needs: str):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *needs)
        return fn

    return add


# Shared steps.


def _counts(s, d):
    return library.allele_counts(V.calls(s, d), V.ref_tiles(s, d))


def _ranked(s, d):
    return library.rank_variants(_counts(s, d))


def _numbered(s, d):
    return library.renumber(V.calls(s, d), _ranked(s, d))


def _carriers(s, d):
    return matrix.genotypes(_numbered(s, d))


def _placed(s, d):
    return reference.place_tiles(V.ref_tiles(s, d))


def _spans(s, d):
    return _placed(s, d).select("tag", "seqname", F.col("pos").alias("start"), (F.col("pos") + F.col("len")).alias("end"))


def _called(s, d):
    return V.blocks(s, d).where("called").select("seqname", "start", "end")


MERGED = 'm AS (SELECT seqname, min("start") AS "start", max("end") AS "end" FROM (SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach THEN 1 ELSE 0 END) OVER (PARTITION BY seqname ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS i FROM (SELECT *, max("end") OVER (PARTITION BY seqname ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM blocks WHERE called)) GROUP BY seqname, i)'
GAPS = 'g AS (SELECT seqname, before AS "start", "start" AS "end" FROM (SELECT seqname, "start", coalesce(max("end") OVER (PARTITION BY seqname ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT * FROM m UNION ALL SELECT DISTINCT seqname, 1000000000, 1000000000 FROM blocks)) WHERE before < "start")'


# Association: the flagship.


def _statistic(a, b, n="n", cases="cases"):
    e, f = f"(({a} + {b}) * {cases} / {n})", f"(({a} + {b}) * ({n} - {cases}) / {n})"
    return f"(({a} - {e}) * ({a} - {e}) / {e} + ({b} - {f}) * ({b} - {f}) / {f})"


def _pvalue(statistic):
    """Chance of a larger chi-square with 1 degree of freedom: 1 - erf(x), x = sqrt(statistic / 2), erf by a series of positive terms."""
    x = f"sqrt({statistic} / 2)"
    return f"CASE WHEN coalesce({statistic}, 0) = 0 THEN 1 ELSE 1 - exp(-{statistic} / 2) * list_sum(list_transform(range(0, 200), lambda n: exp((2 * n + 1) * ln({x}) - lgamma(n + 1.5)))) END"


TESTED = f"""t AS (SELECT c.*, s.is_case FROM carriers c JOIN samples s USING (sample) WHERE s.is_training AND c.tag IN (SELECT tag FROM carriers GROUP BY tag HAVING max(variant) >= 2) AND variant > 1),
    k AS (SELECT count(*) AS n, count(*) FILTER (is_case) AS cases FROM samples WHERE is_training),
    f AS (SELECT tag, variant, sum(CASE WHEN hom THEN 2 ELSE 1 END) / (2 * any_value(n)) AS maf FROM t, k GROUP BY 1, 2),
    ab AS (SELECT tag, variant, hom, count(*) FILTER (is_case) AS a, count(*) FILTER (NOT is_case) AS b FROM t GROUP BY 1, 2, 3),
    stat AS (SELECT tag, variant, hom, a, b, maf, {_statistic("a", "b")} AS statistic FROM ab JOIN f USING (tag, variant), k WHERE maf BETWEEN 0.01 AND 1),
    tested AS (SELECT *, {_pvalue("statistic")} AS pvalue FROM stat)"""


@query(
    "chi2_scan",
    f"WITH {TESTED} SELECT tag, variant, hom, a, b, round(maf, 6) AS maf, round(statistic, 6) AS statistic FROM tested",
    "carriers",
    "samples",
)
def chi2_scan(s, d):
    scan = association.chi2_scan(_carriers(s, d), V.samples(s, d))
    return scan.select("tag", "variant", "hom", "a", "b", F.round("maf", 6).alias("maf"), F.round("statistic", 6).alias("statistic"))


@query("chi2_pvalues", f"WITH {TESTED} SELECT tag, variant, hom, a, b, round(maf, 6) AS maf, round(statistic, 6) AS statistic, round(pvalue, 6) AS pvalue FROM tested WHERE pvalue < 0.5", "carriers", "samples")
def chi2_pvalues(s, d):
    found = association.with_pvalue(association.chi2_scan(_carriers(s, d), V.samples(s, d)), 0.5)
    return found.select("tag", "variant", "hom", "a", "b", *(F.round(c, 6).alias(c) for c in ("maf", "statistic", "pvalue")))


@query("onehot_descriptors", f"WITH {TESTED} SELECT tag, variant, hom::INT AS hom, trunc(pvalue * 1000000)::INT AS p, trunc(-log10(pvalue) * 1000000)::INT AS log_p, trunc(maf * 1000000)::INT AS maf FROM tested", "carriers", "samples")
def onehot_descriptors(s, d):
    return association.descriptors(association.with_pvalue(association.chi2_scan(_carriers(s, d), V.samples(s, d))))


@query("glm_scan")
def glm_scan(s, d):
    x = F.array((F.col("sample") % 7).cast("double"), F.sin(F.col("sample").cast("double")))
    return association.glm_scan(_carriers(s, d), V.samples(s, d).withColumn("pca", x), 0.05)


@query(
    "maf_band",
    "SELECT tag, variant, round(maf, 6) AS maf FROM (SELECT tag, variant, sum(CASE WHEN hom THEN 2 ELSE 1 END) / 120 AS maf FROM carriers GROUP BY 1, 2) WHERE maf BETWEEN 0.1 AND 0.3",
    "carriers",
)
def maf_band(s, d):
    return association.frequency_band(association.frequencies(_carriers(s, d), N_SAMPLES), 0.1, 0.3).withColumn("maf", F.round("maf", 6))


@query(
    "manhattan_points",
    "SELECT seqname, pos, tag, variant, hom, carriers FROM (SELECT tag, variant, hom, count(*) AS carriers FROM carriers WHERE variant > 1 AND tag IN (SELECT tag FROM carriers GROUP BY tag HAVING max(variant) >= 2) GROUP BY 1, 2, 3) JOIN placed USING (tag)",
    "carriers",
    "placed",
)
def manhattan_points(s, d):
    return association.manhattan_points(matrix.homhet_columns(_carriers(s, d)), _placed(s, d)).select("seqname", "pos", "tag", "variant", "hom", "carriers")


# Libraries.


@query("allele_counts", "SELECT tag, hash, n FROM counts", "counts")
def allele_counts(s, d):
    return _counts(s, d)


@query("variant_rank", "SELECT tag, hash, n, variant FROM ranked", "ranked")
def variant_rank(s, d):
    return _ranked(s, d)


@query(
    "tidy_rank",
    "WITH u AS (SELECT tag, hash, sum(n)::BIGINT AS n, max(r) = 1 AS in_ref FROM (SELECT tag, hash, count(*) AS n, 0 AS r FROM calls GROUP BY 1, 2 UNION ALL SELECT DISTINCT tag, 'R' || hash, 0, 1 FROM ref) GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY tag ORDER BY n DESC, hash) AS variant FROM u WHERE n > 0 OR in_ref",
    "calls",
    "ref",
)
def tidy_rank(s, d):
    return library.tidy(V.calls(s, d), V.ref_tiles(s, d).withColumn("hash", F.concat(F.lit("R"), "hash")))


@query("tile_matrix_long", "SELECT sample, tag, phase, CASE WHEN known THEN variant ELSE -1 END AS value FROM numbered", "numbered")
def tile_matrix_long(s, d):
    return matrix.matrix_cells(V.calls(s, d), _ranked(s, d))


@query(
    "tile_matrix_low_coverage",
    "SELECT sample, tag, phase, CASE WHEN tag NOT IN (SELECT tag FROM calls WHERE known GROUP BY tag HAVING count(*) >= 78) THEN 0 WHEN known THEN variant ELSE -1 END AS value FROM numbered",
    "numbered",
)
def tile_matrix_low_coverage(s, d):
    kept = filters.min_coverage(V.calls(s, d), 0.65, N_SAMPLES, "matrix").select("tag").distinct()
    return matrix.matrix_cells(V.calls(s, d), _ranked(s, d), kept)


@query("output_columns", "SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS outcol FROM (SELECT DISTINCT tag FROM calls)", "calls")
def output_columns(s, d):
    return matrix.output_columns(V.calls(s, d))


@query("matrix_rows", "WITH cell AS (SELECT sample, tag, phase, CASE WHEN known THEN variant ELSE -1 END AS value FROM numbered), grid AS (SELECT DISTINCT c.sample, t.tag, p.phase FROM cell c, (SELECT DISTINCT tag FROM cell) t, (SELECT unnest([0, 1]) AS phase) p) SELECT sample, string_agg(coalesce(value, 0)::VARCHAR, ',' ORDER BY tag, phase) AS cells FROM grid LEFT JOIN cell USING (sample, tag, phase) GROUP BY sample", "numbered")
def matrix_rows(s, d):
    cells = matrix.matrix_cells(V.calls(s, d), _ranked(s, d))
    return matrix.dense_rows(cells, matrix.output_columns(cells)).select("sample", F.array_join(F.transform("row", lambda x: x.cast("string")), ",").alias("cells"))


@query("filter_max_variants", "SELECT sample, tag, phase, hash, known FROM calls WHERE tag NOT IN (SELECT tag FROM calls GROUP BY tag HAVING count(DISTINCT hash) > 17)", "calls")
def filter_max_variants(s, d):
    return filters.max_variants(V.calls(s, d), 17)


@query("filter_max_variants_by_id", "SELECT sample, tag, phase, hash, known, variant FROM numbered WHERE tag NOT IN (SELECT tag FROM numbered WHERE variant > 12)", "numbered")
def filter_max_variants_by_id(s, d):
    return filters.max_variant_number(_numbered(s, d), 12).select("sample", "tag", "phase", "hash", "known", "variant")


def _coverage_sql(least, where=""):
    return f"SELECT sample, tag, phase, hash, known FROM calls WHERE tag IN (SELECT tag FROM calls {where} GROUP BY tag HAVING count(*) >= {least})"


@query("filter_min_coverage_library", _coverage_sql(int(2 * 0.92 * N_SAMPLES + 1)), "calls")
def filter_min_coverage_library(s, d):
    return filters.min_coverage(V.calls(s, d), 0.92, N_SAMPLES)


@query("filter_min_coverage_command", _coverage_sql(int(0.92 * N_SAMPLES * 2)), "calls")
def filter_min_coverage_command(s, d):
    return filters.min_coverage(V.calls(s, d), 0.92, N_SAMPLES, "command")


@query("filter_min_coverage_matrix", _coverage_sql(2 * 39, "WHERE known"), "calls")
def filter_min_coverage_matrix(s, d):
    return filters.min_coverage(V.calls(s, d), 0.65, N_SAMPLES, "matrix")


@query("pair_coverage", "SELECT tag, count(*) AS n_both FROM (SELECT tag, sample FROM calls WHERE known GROUP BY 1, 2 HAVING count(*) = 2) GROUP BY tag HAVING count(*) >= 25", "calls")
def pair_coverage(s, d):
    return filters.pair_coverage(V.calls(s, d), 25)


@query("max_tag_lt", "SELECT sample, tag, phase, hash, known FROM calls WHERE tag < 50", "calls")
def max_tag_lt(s, d):
    return filters.max_tag(V.calls(s, d), 50)


@query("max_tag_le", "SELECT sample, tag, phase, hash, known FROM calls WHERE tag <= 50", "calls")
def max_tag_le(s, d):
    return filters.max_tag(V.calls(s, d), 50, inclusive=True)


@query("match_genome", "SELECT sample, tag, phase, hash, known FROM calls WHERE regexp_matches(sample::VARCHAR, '^[1-3].?$')", "calls")
def match_genome(s, d):
    return filters.match_genome(V.calls(s, d), "^[1-3].?$")


@query(
    "filter_library",
    "SELECT sample, tag, phase, hash, known FROM calls WHERE tag NOT IN (SELECT tag FROM calls GROUP BY tag HAVING count(DISTINCT hash) > 18) AND tag IN (SELECT tag FROM calls GROUP BY tag HAVING count(*) >= 97) AND tag < 150 AND regexp_matches(sample::VARCHAR, '[02468]$')",
    "calls",
)
def filter_library(s, d):
    return filters.apply(V.calls(s, d), N_SAMPLES, 18, 0.8, 150, "[02468]$")


def _variants(s, d):
    return V.calls(s, d).groupBy("tag", "hash").agg(F.max("known").alias("known")).select("tag", "hash", F.when(F.col("known"), F.col("hash")).alias("seq"), F.lit(False).alias("is_ref"))


@query(
    "merge_libraries",
    "SELECT tag, hash, max(seq) AS seq, max(is_ref) AS is_ref FROM (SELECT DISTINCT tag, hash, CASE WHEN known THEN hash END AS seq, false AS is_ref FROM calls UNION ALL SELECT tag, hash, hash, true FROM ref UNION ALL SELECT tag, 'x' || hash, NULL, false FROM ref) GROUP BY 1, 2",
    "calls",
    "ref",
)
def merge_libraries(s, d):
    ref = V.ref_tiles(s, d)
    a = ref.select("tag", "hash", F.col("hash").alias("seq"), F.lit(True).alias("is_ref"))
    b = ref.select("tag", F.concat(F.lit("x"), "hash").alias("hash"), F.lit(None).cast("string").alias("seq"), F.lit(False).alias("is_ref"))
    return library.merge_libraries(_variants(s, d), a, b)


@query("merge_integrity", "SELECT sample, tag, phase, hash, known FROM calls WHERE (tag, hash) NOT IN (SELECT (tag, hash) FROM ranked WHERE variant <= 10)", "calls", "ranked")
def merge_integrity(s, d):
    return library.missing_variants(V.calls(s, d), _ranked(s, d).where("variant <= 10"))


@query("renumbered_calls", "SELECT sample, tag, phase, hash, variant FROM numbered", "numbered")
def renumbered_calls(s, d):
    return _numbered(s, d).select("sample", "tag", "phase", "hash", "variant")


@query("reference_path", "SELECT ref.tag, ref.hash, seqname, step, coalesce(variant, 0) AS variant FROM ref LEFT JOIN (SELECT * FROM ranked WHERE variant > 1) r USING (tag, hash)", "ref", "ranked")
def reference_path(s, d):
    return library.renumber_path(V.ref_tiles(s, d).select("tag", "hash", "seqname", "step"), _ranked(s, d).where("variant > 1"))


@query("tag_differences", "(SELECT tag, 'a' AS side FROM (SELECT DISTINCT tag FROM calls) WHERE tag < 10) UNION ALL (SELECT tag, 'b' FROM (SELECT DISTINCT tag FROM calls) WHERE tag >= 190)", "calls")
def tag_differences(s, d):
    tags = V.calls(s, d).select("tag").distinct()
    return library.tag_differences(tags.where("tag < 190"), tags.where("tag >= 10"))


@query("slice_ranges", "SELECT tag // 30 AS chunk, min(tag) AS start_tag, count(*) AS n FROM calls GROUP BY 1", "calls")
def slice_ranges(s, d):
    return library.slice_offsets(V.calls(s, d), 30)


@query("slice_union", "SELECT tag, sample, phase, CASE WHEN variant > 0 THEN variant * 2 + ns ELSE 0 END AS variant, ns FROM (SELECT *, 0 AS ns FROM numbered WHERE sample < 30 UNION ALL SELECT *, 1 FROM numbered WHERE sample >= 30)", "numbered")
def slice_union(s, d):
    n = _numbered(s, d).select("tag", "sample", "phase", "variant")
    return library.union_namespaced([n.where("sample < 30"), n.where("sample >= 30")])


@query("library_totals", "SELECT (SELECT count(DISTINCT sample) FROM calls) AS genomes, (SELECT count(DISTINCT tag) FROM ranked) AS tags, (SELECT count(*) FROM ranked) AS tile_variants", "calls", "ranked")
def library_totals(s, d):
    return library.totals(V.calls(s, d), _ranked(s, d))


@query("library_stats", "SELECT sample, sum(CASE WHEN known THEN 148 + tag % 7 ELSE 0 END)::BIGINT AS called_bases FROM calls GROUP BY sample", "calls")
def library_stats(s, d):
    bases = V.calls(s, d).where("known").select("tag", "hash").distinct().withColumn("bases", 148 + F.col("tag") % 7)
    return library.called_bases(V.calls(s, d), bases)


@query("tag_placement_histogram", "SELECT times, count(*) AS tags FROM (SELECT l_partkey % 997 AS tag, count(*) AS times FROM lineitem GROUP BY 1) GROUP BY times")
def tag_placement_histogram(s, d):
    return library.placement_histogram(V.table(s, d, "lineitem").select((F.col("l_partkey") % 997).alias("tag")))


@query("variant_size_histogram", "SELECT len, known, count(*) AS n FROM (SELECT DISTINCT tag, hash, 148 + (tag % 7) * 10 AS len, known FROM calls) GROUP BY 1, 2", "calls")
def variant_size_histogram(s, d):
    rows = V.calls(s, d).select("tag", "hash", (148 + (F.col("tag") % 7) * 10).alias("len"), "known").distinct()
    return library.size_histogram(rows)


@query("describe_library", "SELECT 'calls' AS entity, count(*) AS n FROM calls UNION ALL SELECT 'ref_paths', count(*) FROM ref UNION ALL SELECT 'tile_variants', count(*) FROM ranked", "calls", "ref", "ranked")
def describe_library(s, d):
    return library.describe(calls=V.calls(s, d), ref_paths=V.ref_tiles(s, d), tile_variants=_ranked(s, d))


@query("dump_variants", "SELECT r.tag, r.variant, r.hash = p.hash AS is_ref, p.seqname, p.pos + 1 AS pos, upper(r.hash) AS seq FROM ranked r JOIN placed p ON r.tag = p.tag WHERE r.tag IN (4, 6, 7, 120)", "ranked", "placed")
def dump_variants(s, d):
    return library.dump_variants(_ranked(s, d), _placed(s, d), [4, 6, 7, 120])


@query("common_variants", "SELECT tag, variant, count(*) AS n, max(sample) AS example FROM numbered WHERE variant BETWEEN 1 AND 4 GROUP BY 1, 2 HAVING count(*) BETWEEN 0.1 * 120 AND 0.2 * 120", "numbered")
def common_variants(s, d):
    return library.common_variants(_numbered(s, d), 0.1, 0.2, N_SAMPLES)


@query("common_variants_limited", "WITH c AS (SELECT tag, variant, count(*) AS n, max(sample) AS example FROM numbered WHERE variant BETWEEN 1 AND 4 GROUP BY 1, 2 HAVING count(*) BETWEEN 0.1 * 120 AND 0.2 * 120), p AS (SELECT tag, coalesce(sum(count(*)) OVER (ORDER BY tag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c GROUP BY tag) SELECT * FROM c WHERE tag IN (SELECT tag FROM p WHERE before < 16)", "numbered")
def common_variants_limited(s, d):
    return library.common_variants(_numbered(s, d), 0.1, 0.2, N_SAMPLES, limit=16)


@query("common_variants_annotated", "SELECT c.tag, c.variant, c.n, 'chr:' || c.tag::VARCHAR AS note FROM (SELECT tag, variant, count(*) AS n FROM numbered WHERE variant BETWEEN 1 AND 4 GROUP BY 1, 2 HAVING count(*) BETWEEN 12 AND 24) c JOIN (SELECT DISTINCT tag, variant FROM ranked WHERE n % 2 = 0) a USING (tag, variant)", "numbered")
def common_variants_annotated(s, d):
    notes = _ranked(s, d).where("n % 2 = 0").select("tag", "variant", F.concat(F.lit("chr:"), F.col("tag").cast("string")).alias("note"))
    return library.with_annotations(library.common_variants(_numbered(s, d), 0.1, 0.2, N_SAMPLES), notes).select("tag", "variant", "n", "note")


# One-hot and matrices.

RECODED = "cell AS (SELECT sample, tag, phase, CASE WHEN known THEN variant ELSE -1 END AS value FROM numbered), col AS (SELECT tag, phase, value, row_number() OVER (ORDER BY tag, phase, value) - 1 AS outcol FROM (SELECT tag, phase, unnest(range(1, top + 1)) AS value FROM (SELECT tag, phase, max(value) AS top FROM cell GROUP BY 1, 2) WHERE top > 0))"


@query("onehot_recode", f"WITH {RECODED} SELECT tag, phase, value, outcol FROM col", "numbered")
def onehot_recode(s, d):
    return matrix.onehot_recode(matrix.matrix_cells(V.calls(s, d), _ranked(s, d)))


@query("onehot_cells", f"WITH {RECODED} SELECT sample, outcol FROM cell JOIN col USING (tag, phase, value)", "numbered")
def onehot_cells(s, d):
    cells = matrix.matrix_cells(V.calls(s, d), _ranked(s, d))
    return matrix.onehot_cells(cells, matrix.onehot_recode(cells))


HOMHET = "hh AS (SELECT tag, variant, hom, count(*) AS carriers FROM carriers WHERE variant > 1 AND tag IN (SELECT tag FROM carriers GROUP BY tag HAVING max(variant) >= 2) GROUP BY 1, 2, 3), nc AS (SELECT *, row_number() OVER (ORDER BY tag, variant, hom DESC) - 1 AS col FROM hh)"


@query("onehot_homhet", f"WITH {HOMHET} SELECT * FROM hh", "carriers")
def onehot_homhet(s, d):
    return matrix.homhet_columns(_carriers(s, d))


@query("onehot_coo", f"WITH {HOMHET} SELECT sample AS row, col FROM carriers JOIN nc USING (tag, variant, hom)", "carriers")
def onehot_coo(s, d):
    columns = matrix.numbered_columns(matrix.homhet_columns(_carriers(s, d)))
    return matrix.coordinates(_carriers(s, d), columns, V.samples(s, d).select("sample", F.col("sample").alias("idx")))


@query("chunk_columns", f"WITH {HOMHET}, z AS (SELECT tag // 40 AS chunk, count(*) AS n FROM hh GROUP BY 1) SELECT chunk, n, coalesce(sum(n) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM z", "carriers")
def chunk_columns(s, d):
    return matrix.chunk_columns(matrix.homhet_columns(_carriers(s, d)), 40)


@query("stride_sample", f"WITH {HOMHET}, st AS (SELECT greatest(1, ceil((max(col) // 2 + 1) / 500)::BIGINT) AS w FROM nc) SELECT tag, variant, hom, carriers, 2 * ((col // 2) // w) + col % 2 AS col FROM nc, st WHERE (col // 2) % w = 0", "carriers")
def stride_sample(s, d):
    return matrix.stride_sample(matrix.numbered_columns(matrix.homhet_columns(_carriers(s, d))), 500)


def _notes(s, d):
    """Annotations: every variant over 1 differs by one id; multiples of 4 couldn't be compared, and 1 is the reference."""
    hgvs = F.when(F.col("variant") == 1, "=").when(F.col("variant") % 4 == 0, "").otherwise(F.concat(F.lit("g."), F.col("tag").cast("string"), F.lit("v"), (F.col("variant") % 3).cast("string")))
    return _ranked(s, d).select("tag", "variant", hgvs.alias("hgvs"))


NOTES = "note AS (SELECT tag, variant, CASE WHEN variant = 1 THEN '=' WHEN variant % 4 = 0 THEN '' ELSE 'g.' || tag::VARCHAR || 'v' || (variant % 3)::VARCHAR END AS hgvs FROM ranked), rv AS (SELECT ref.tag, variant AS rv FROM ref JOIN ranked USING (tag, hash)), dif AS (SELECT DISTINCT hgvs, tag, variant FROM note WHERE hgvs NOT IN ('', '=')), here AS (SELECT h.hgvs, n.sample, n.phase, n.tag, n.variant, dif.variant IS NOT NULL AS has, n.variant = rv AS is_ref, c.variant IS NOT NULL AS compared FROM (SELECT DISTINCT hgvs, tag FROM dif) h JOIN numbered n ON h.tag = n.tag LEFT JOIN rv ON rv.tag = n.tag LEFT JOIN dif ON dif.hgvs = h.hgvs AND dif.tag = n.tag AND dif.variant = n.variant LEFT JOIN (SELECT DISTINCT tag, variant FROM note WHERE hgvs <> '') c ON c.tag = n.tag AND c.variant = n.variant)"


def _cells_sql(value):
    return f"WITH {NOTES} SELECT hgvs, sample, phase, max({value})::BIGINT AS value FROM here GROUP BY 1, 2, 3"


def _ref_variants(s, d):
    return V.ref_tiles(s, d).join(_ranked(s, d), ["tag", "hash"]).select("tag", "variant")


@query("hgvs_matrix_chunked", _cells_sql("CASE WHEN has THEN 1 WHEN is_ref THEN 0 WHEN compared THEN 0 ELSE -1 END"), "numbered", "ref")
def hgvs_matrix_chunked(s, d):
    return matrix.hgvs_cells(_notes(s, d), _numbered(s, d), _ref_variants(s, d), "chunked")


@query("hgvs_matrix_single", _cells_sql("CASE WHEN has THEN 1 WHEN is_ref THEN 0 ELSE -1 END"), "numbered", "ref")
def hgvs_matrix_single(s, d):
    return matrix.hgvs_cells(_notes(s, d), _numbered(s, d), _ref_variants(s, d), "single")


@query("hgvs_matrix_present", _cells_sql("CASE WHEN has THEN 1 ELSE 0 END"), "numbered", "ref")
def hgvs_matrix_present(s, d):
    return matrix.hgvs_cells(_notes(s, d), _numbered(s, d), _ref_variants(s, d), "present")


HOMHET_CELLS = "cell AS (SELECT hgvs, sample, phase, max(CASE WHEN has THEN 1 WHEN is_ref THEN 0 WHEN compared THEN 0 ELSE -1 END) AS value FROM here GROUP BY 1, 2, 3), pair AS (SELECT hgvs, sample, coalesce(max(value) FILTER (phase = 0), -1) AS a, coalesce(max(value) FILTER (phase = 1), -1) AS b FROM cell GROUP BY 1, 2), hh AS (SELECT hgvs, sample, CASE WHEN a < 0 OR b < 0 THEN -1 WHEN a = 1 AND b = 1 THEN 1 ELSE 0 END::BIGINT AS hom, CASE WHEN a < 0 OR b < 0 THEN -1 WHEN (a = 1) <> (b = 1) THEN 1 ELSE 0 END::BIGINT AS het FROM pair)"


@query(
    "hgvs_homhet",
    f"WITH {NOTES}, {HOMHET_CELLS} SELECT * FROM hh",
    "numbered",
    "ref",
)
def hgvs_homhet(s, d):
    return matrix.hgvs_homhet(matrix.hgvs_cells(_notes(s, d), _numbered(s, d), _ref_variants(s, d), "chunked"))


@query(
    "hgvs_filter",
    f"""WITH {NOTES}, {HOMHET_CELLS}, k AS (SELECT count(*) AS n, count(*) FILTER (is_case) AS cases FROM samples WHERE is_training),
    c AS (SELECT hgvs, count(*) FILTER (hom >= 0) AS called, count(*) FILTER (hom = 1 AND is_case) AS hom_a, count(*) FILTER (hom = 1 AND NOT is_case) AS hom_b, count(*) FILTER (het = 1 AND is_case) AS het_a, count(*) FILTER (het = 1 AND NOT is_case) AS het_b FROM hh JOIN samples USING (sample) WHERE is_training GROUP BY hgvs),
    x AS (SELECT c.*, CASE WHEN hom_a + hom_b > 0 THEN {_statistic("hom_a", "hom_b")} END AS x_hom, CASE WHEN het_a + het_b > 0 THEN {_statistic("het_a", "het_b")} END AS x_het FROM c, k WHERE called >= 10),
    p AS (SELECT *, {_pvalue("x_hom")} AS ph, {_pvalue("x_het")} AS pt FROM x)
    SELECT hgvs, called, hom_a, hom_b, het_a, het_b, round(ph, 6) AS p_hom, round(pt, 6) AS p_het FROM p WHERE ph <= 0.2 OR pt <= 0.2""",
    "numbered",
    "ref",
    "samples",
)
def hgvs_filter(s, d):
    cells = matrix.hgvs_homhet(matrix.hgvs_cells(_notes(s, d), _numbered(s, d), _ref_variants(s, d), "chunked"))
    found = association.hgvs_filter(cells, V.samples(s, d), 0.2, 10)
    return found.withColumn("p_hom", F.round("p_hom", 6)).withColumn("p_het", F.round("p_het", 6))


@query("pca_gram", f"WITH {HOMHET}, o AS (SELECT sample AS row, col FROM carriers JOIN nc USING (tag, variant, hom)) SELECT x.row AS a, y.row AS b, count(*) AS n FROM o x JOIN o y ON x.col = y.col WHERE x.row <= y.row GROUP BY 1, 2", "carriers")
def pca_gram(s, d):
    return pca.gram_counts(onehot_coo(s, d))


@query("pca")
def pca_scores(s, d):
    samples = V.samples(s, d).withColumn("idx", F.col("sample"))
    scores = pca.pca(onehot_coo(s, d), samples, 4)
    return scores.select("idx", *(F.round(F.element_at("pca", k + 1), 4).alias(f"pc{k + 1}") for k in range(4)))


@query("pca_plot_points")
def pca_plot_points(s, d):
    samples = V.samples(s, d).withColumn("idx", F.col("sample"))
    return pca.plot_points(pca.pca(onehot_coo(s, d), samples, 2).withColumn("status", F.when(F.col("is_case"), "case").otherwise("control")), 1, 2, "status")


# Reference and intervals.


@query("ref_tiles", "SELECT tag, seqname, step, hash, len, bases, pos FROM placed", "placed")
def ref_tiles(s, d):
    return _placed(s, d)


@query("ref_unique_tiles", "SELECT tag, seqname, step, len, pos FROM (SELECT l_partkey * 53 + l_suppkey AS tag, 'chr' || (l_suppkey % 3)::VARCHAR AS seqname, o AS step, 148 AS len, (row_number() OVER (PARTITION BY l_suppkey % 3 ORDER BY o) - 1) * 124 AS pos, count(*) OVER (PARTITION BY l_partkey * 53 + l_suppkey) AS c FROM (SELECT DISTINCT l_partkey, l_suppkey, l_partkey * 100000 + l_suppkey AS o FROM lineitem)) WHERE c = 1")
def ref_unique_tiles(s, d):
    rows = V.table(s, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    path = rows.select((F.col("l_partkey") * 53 + F.col("l_suppkey")).alias("tag"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 3).cast("string")).alias("seqname"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("step"), F.lit(148).alias("len"))
    return reference.unique_tiles(reference.place_tiles(path))


@query("ref_successor", "SELECT tag, seqname, pos, coalesce(lead(tag) OVER (PARTITION BY seqname ORDER BY pos, tag), -1) AS next_tag FROM placed", "placed")
def ref_successor(s, d):
    return reference.successors(_placed(s, d)).select("tag", "seqname", "pos", "next_tag")


@query("tile_bounds", "SELECT tag, seqname, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE pos END AS \"start\", coalesce(lead(pos) OVER w + 24, 100000) AS \"end\" FROM placed WINDOW w AS (PARTITION BY seqname ORDER BY pos)", "placed")
def tile_bounds(s, d):
    return reference.tile_bounds(_placed(s, d), F.lit(100000)).select("tag", "seqname", "start", "end")


@query("reference_sequence", "SELECT seqname, string_agg(CASE WHEN n = 1 THEN seq ELSE substr(seq, 3) END, '' ORDER BY step) AS seq FROM (SELECT seqname, step, hash || 'ac' AS seq, row_number() OVER (PARTITION BY seqname ORDER BY step) AS n FROM ref) GROUP BY seqname", "ref")
def reference_sequence(s, d):
    return reference.reference_sequence(V.ref_tiles(s, d).withColumn("seq", F.concat("hash", F.lit("ac"))), 2)


@query("reference_lengths", "SELECT doc_id::VARCHAR AS label, sum(length(trim(line)))::BIGINT AS length FROM (SELECT doc_id, unnest(string_split(seq, 'n')) AS line FROM contigs) GROUP BY 1", "contigs")
def reference_lengths(s, d):
    """Bases of contigs cut into lines where a base isn't known."""
    return reference.reference_lengths(V.contigs(s, d).select(F.col("doc_id").cast("string").alias("label"), F.explode(F.split("seq", "n")).alias("line")))


BED = 'SELECT seqname, pos AS "start", pos + len AS "end", tag, {score} AS score, CASE WHEN lag(pos) OVER w IS NULL THEN pos ELSE pos + 24 END AS thick_start, CASE WHEN lead(pos) OVER w IS NULL THEN pos + len ELSE pos + len - 24 END AS thick_end FROM {rows} WINDOW w AS (PARTITION BY seqname ORDER BY pos)'


@query("tiling_bed", BED.format(score="(1000 * bases) // len", rows="placed"), "placed")
def tiling_bed(s, d):
    return reference.tiling_bed(_placed(s, d))


@query("coverage_bed", BED.format(score="((1000 * n) // 60) // 2", rows="(SELECT placed.*, coalesce(n, 0) AS n FROM placed LEFT JOIN (SELECT tag, count(*) AS n FROM calls GROUP BY tag) USING (tag))"), "placed", "calls")
def coverage_bed(s, d):
    return reference.coverage_bed(_placed(s, d), V.calls(s, d), N_SAMPLES)


@query("bed_lines", "SELECT concat_ws(' ', seqname, \"start\", \"end\", tag, score, '.', thick_start, thick_end) AS value FROM (" + BED.format(score="(1000 * bases) // len", rows="placed") + ")", "placed")
def bed_lines(s, d):
    return reference.bed_line(reference.tiling_bed(_placed(s, d)))


MEETS = 'r.seqname = s.seqname AND r."start" <= s."end" AND r."end" >= s."start"'


@query("region_semi_join", f'SELECT * FROM spans s WHERE EXISTS (SELECT 1 FROM regions r WHERE {MEETS})', "spans", "regions")
def region_semi_join(s, d):
    return intervals.semi_join(_spans(s, d), V.regions(s, d))


@query("region_anti_join", f'SELECT * FROM spans s WHERE NOT EXISTS (SELECT 1 FROM regions r WHERE {MEETS})', "spans", "regions")
def region_anti_join(s, d):
    return intervals.semi_join(_spans(s, d), V.regions(s, d), how="left_anti")


@query("region_binned_join", f'SELECT * FROM spans s WHERE EXISTS (SELECT 1 FROM regions r WHERE {MEETS})', "spans", "regions")
def region_binned_join(s, d):
    return intervals.binned_semi_join(_spans(s, d), V.regions(s, d), width=256)


@query("interval_merge", f"WITH {MERGED} SELECT * FROM m", "blocks")
def interval_merge(s, d):
    return intervals.merge(_called(s, d))


def _sizes(s, d):
    return V.blocks(s, d).select("seqname", F.lit(1_000_000_000).cast("long").alias("size")).distinct()


@query("interval_complement", f"WITH {MERGED}, {GAPS} SELECT * FROM g", "blocks")
def interval_complement(s, d):
    return intervals.complement(_called(s, d), _sizes(s, d))


@query("interval_intersect", 'SELECT s.seqname, greatest(s."start", r."start") AS "start", least(s."end", r."end") AS "end" FROM spans s JOIN regions r ON r.seqname = s.seqname AND r."start" < s."end" AND r."end" > s."start"', "spans", "regions")
def interval_intersect(s, d):
    return intervals.intersect(_spans(s, d), V.regions(s, d), 512)


@query(
    "interval_subtract",
    'WITH p AS (SELECT seqname, "start", "end" FROM spans), e AS (SELECT seqname, p AS "start", lead(p) OVER (PARTITION BY seqname ORDER BY p) AS "end" FROM (SELECT seqname, "start" AS p FROM spans UNION SELECT seqname, "end" FROM spans UNION SELECT seqname, "start" FROM regions UNION SELECT seqname, "end" FROM regions)), k AS (SELECT * FROM e WHERE "end" IS NOT NULL AND EXISTS (SELECT 1 FROM spans s WHERE s.seqname = e.seqname AND s."start" <= e."start" AND s."end" >= e."end") AND NOT EXISTS (SELECT 1 FROM regions r WHERE r.seqname = e.seqname AND r."start" <= e."start" AND r."end" >= e."end")) SELECT seqname, min("start") AS "start", max("end") AS "end" FROM (SELECT *, sum(n) OVER (PARTITION BY seqname ORDER BY "start") AS i FROM (SELECT *, CASE WHEN lag("end") OVER (PARTITION BY seqname ORDER BY "start") = "start" THEN 0 ELSE 1 END AS n FROM k)) GROUP BY seqname, i',
    "spans",
    "regions",
)
def interval_subtract(s, d):
    return intervals.subtract(_spans(s, d), V.regions(s, d), 512)


@query("contained_intersect", 'SELECT * FROM regions r WHERE EXISTS (SELECT 1 FROM spans s WHERE s.seqname = r.seqname AND r."start" >= s."start" AND r."end" <= s."end")', "spans", "regions")
def contained_intersect(s, d):
    return intervals.contained(V.regions(s, d), _spans(s, d), 512)


@query("gvcf_islands", f"WITH {MERGED} SELECT * FROM m", "blocks")
def gvcf_islands(s, d):
    return intervals.called_islands(V.blocks(s, d))


def _regions_sql(unreported):
    """Blocks read one by one: e is the end so far, op where the open region began, (x, y) a region that this block ends."""
    gap, u = 'o."start" > w.e', "true" if unreported else "false"
    op = f"CASE WHEN {gap} AND {u} AND w.op IS NULL THEN w.e WHEN {gap} AND NOT {u} THEN NULL ELSE w.op END"
    inside = 'o."start" < w.e'
    return f"""WITH RECURSIVE {V.SQL["blocks"]}, o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY seqname ORDER BY "start", "end", called DESC) AS i FROM blocks),
    w AS (SELECT seqname, i, "end" AS e, CASE WHEN called THEN "start" END AS op, NULL::BIGINT AS x, NULL::BIGINT AS y FROM o WHERE i = 1
      UNION ALL SELECT o.seqname, o.i,
        CASE WHEN {inside} THEN CASE WHEN w.op IS NOT NULL AND o.called THEN greatest(w.e, o."end") ELSE w.e END ELSE o."end" END,
        CASE WHEN {inside} THEN w.op WHEN o.called THEN coalesce({op}, o."start") END,
        CASE WHEN {inside} THEN NULL WHEN {gap} AND NOT {u} THEN w.op WHEN NOT o.called THEN {op} END,
        CASE WHEN {gap} AND NOT {u} THEN w.e ELSE o."start" END
      FROM w JOIN o ON o.seqname = w.seqname AND o.i = w.i + 1)
    SELECT seqname, x AS "start", y AS "end" FROM w WHERE x IS NOT NULL
    UNION ALL SELECT seqname, op, e FROM w WHERE op IS NOT NULL AND (seqname, i) IN (SELECT (seqname, max(i)) FROM o GROUP BY seqname)"""


@query("gvcf_regions", _regions_sql(False))
def gvcf_regions(s, d):
    return intervals.called_regions(V.blocks(s, d))


@query("gvcf_regions_unreported_called", _regions_sql(True))
def gvcf_regions_unreported_called(s, d):
    return intervals.called_regions(V.blocks(s, d), unreported_called=True)


@query(
    "overlap_clean",
    f"""WITH o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY seqname ORDER BY "start", "end") AS i FROM (SELECT seqname, "start", "end" + 3 AS "end" FROM blocks)),
    head AS MATERIALIZED (SELECT seqname, "start", min(i) AS i FROM o GROUP BY 1, 2),
    node AS MATERIALIZED (SELECT o.seqname AS grp, o.i, h.i AS nxt FROM o ASOF LEFT JOIN head h ON o.seqname = h.seqname AND o."end" <= h."start"), {V.chain("node")}
    SELECT seqname, "start", "end" FROM o JOIN s0 ON seqname = grp AND o.i = s0.i""",
    "blocks",
)
def overlap_clean(s, d):
    return intervals.drop_overlapping(V.blocks(s, d).select("seqname", "start", (F.col("end") + 3).alias("end")))


# Sequences.


@query("contig_scan", "SELECT doc_id, length(seq) AS length, length(regexp_replace(seq, '[^acgt]', '', 'g')) AS bases, NOT regexp_matches(seq, '[^acgt]') AS known FROM contigs", "contigs")
def contig_scan(s, d):
    return V.contigs(s, d).select("doc_id", F.length("seq").cast("long").alias("length"), Q.count_bases(F.col("seq")).cast("long").alias("bases"), Q.is_known(F.col("seq")).alias("known"))


KMERS = "k AS (SELECT doc_id, i - 1 AS pos, tag FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - 4)) AS i FROM contigs WHERE length(seq) >= 6) JOIN tags ON substr(seq, i, 6) = tagseq)"


@query("kmer_hits", f"WITH {KMERS} SELECT doc_id, pos, tag FROM k", "contigs", "tags")
def kmer_hits(s, d):
    return tiling.kmer_hits(V.contigs(s, d), V.tags(s, d), 6)


def _hits(s, d):
    return kmer_hits(s, d).select(F.col("doc_id").alias("sample"), F.lit(0).alias("phase"), F.lit("c").alias("seqname"), "tag", "pos")


@query("dup_tag_drop", f"WITH {KMERS} SELECT sample, pos, tag FROM (SELECT doc_id AS sample, pos, tag, count(*) OVER (PARTITION BY doc_id, tag) AS n FROM k) WHERE n = 1", "contigs", "tags")
def dup_tag_drop(s, d):
    return filters.drop_duplicate_tags(_hits(s, d)).select("sample", "pos", "tag")


@query("kept_and_dropped_tags", f"WITH {KMERS} SELECT sample, 0 AS phase, count(*) FILTER (n = 1) AS kept, count(*) FILTER (n > 1) AS dropped FROM (SELECT doc_id AS sample, tag, count(*) AS n FROM k GROUP BY 1, 2) GROUP BY 1", "contigs", "tags")
def kept_and_dropped_tags(s, d):
    return tiling.kept_and_dropped(_hits(s, d))


#: Of overlapping hits the first, from the left: each hit points to the next that begins after it.
GREEDY = f"{KMERS}, spot AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM k), node AS MATERIALIZED (SELECT a.doc_id AS grp, a.i, b.i AS nxt FROM spot a ASOF LEFT JOIN spot b ON a.doc_id = b.doc_id AND a.pos + 6 <= b.pos), {V.chain('node')}, g AS MATERIALIZED (SELECT doc_id, pos, tag FROM spot JOIN s0 ON doc_id = grp AND spot.i = s0.i)"


@query("greedy_hits", f"WITH {GREEDY} SELECT doc_id AS sample, pos, tag FROM g", "contigs", "tags")
def greedy_hits(s, d):
    hits = tiling.greedy_hits(_hits(s, d), 6, ("sample", "phase", "seqname"))
    return hits.select("sample", F.explode("hits").alias("h")).select("sample", "h.pos", "h.tag")


def _tiles(s, d, **options):
    contigs = V.contigs(s, d).select(F.col("doc_id").alias("sample"), F.lit(0).alias("phase"), F.lit("c").alias("seqname"), "seq")
    return tiling.tile_contigs(contigs, V.tags(s, d), 6, **options)


@query(
    "tile_contigs",
    f"""WITH {GREEDY}, b AS (SELECT g.doc_id, (row_number() OVER w - 1)::INT AS step, tag::INT AS tag, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE pos END AS "start", coalesce(lead(pos) OVER w + 6, length(seq)) AS "end", seq FROM g JOIN contigs c ON c.doc_id = g.doc_id WINDOW w AS (PARTITION BY g.doc_id ORDER BY pos))
    SELECT doc_id AS sample, 0 AS phase, 'c' AS seqname, step, tag, "start", "end", substr(seq, "start" + 1, "end" - "start") AS seq FROM b""",
    "contigs",
    "tags",
)
def tile_contigs(s, d):
    return _tiles(s, d, keep_duplicates=True)[0]


@query(
    "lis_filter",
    f"""WITH RECURSIVE {GREEDY}, d AS MATERIALIZED (SELECT doc_id, pos, tag, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, tag) AS times FROM g) WHERE times = 1),
    l AS (SELECT doc_id, i, [tag] AS tags, [1::BIGINT] AS lens FROM d WHERE i = 1
      UNION ALL SELECT d.doc_id, d.i, list_append(l.tags, d.tag), list_append(l.lens, 1 + list_max(list_transform(range(1, len(l.tags) + 1), lambda k: CASE WHEN l.tags[k] < d.tag THEN l.lens[k] ELSE 0 END))) FROM l JOIN d ON d.doc_id = l.doc_id AND d.i = l.i + 1),
    m AS MATERIALIZED (SELECT doc_id, i, lens[i] AS n FROM l),
    top AS MATERIALIZED (SELECT doc_id, max(i) AS last FROM m JOIN (SELECT doc_id, max(n) AS n FROM m GROUP BY 1) USING (doc_id, n) GROUP BY 1),
    back AS MATERIALIZED (SELECT m.doc_id AS grp, last - m.i + 1 AS i, last - max(p.i) + 1 AS nxt FROM m JOIN top ON top.doc_id = m.doc_id AND m.i <= last LEFT JOIN m p ON p.doc_id = m.doc_id AND p.n = m.n - 1 AND p.i < m.i GROUP BY m.doc_id, m.i, last),
    {V.chain('back', 17, 'r')},
    h AS (SELECT d.doc_id, pos, tag FROM d JOIN top ON top.doc_id = d.doc_id JOIN rs0 ON grp = d.doc_id AND rs0.i = last - d.i + 1)
    SELECT h.doc_id AS sample, (row_number() OVER w - 1)::INT AS step, tag::INT AS tag, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE pos END AS "start", coalesce(lead(pos) OVER w + 6, length(seq)) AS "end" FROM h JOIN contigs c ON c.doc_id = h.doc_id WINDOW w AS (PARTITION BY h.doc_id ORDER BY pos)""",
    "contigs",
    "tags",
)
def lis_filter(s, d):
    return _tiles(s, d, skip_out_of_order=True)[0].select("sample", "step", "tag", "start", "end")


@query(
    "import_stats",
    f"""WITH {GREEDY}, n AS (SELECT doc_id, count(*) FILTER (times = 1) AS path_length, count(*) FILTER (times > 1) AS dropped_dup FROM (SELECT doc_id, count(*) OVER (PARTITION BY doc_id, tag) AS times FROM g) GROUP BY 1)
    SELECT c.doc_id AS sample, coalesce(length(seq), 0) AS length, coalesce(length(regexp_replace(seq, '[^acgt]', '', 'g')), 0) AS bases, coalesce(path_length, 0) AS path_length, coalesce(dropped_dup, 0) AS dropped_dup, 0::BIGINT AS dropped_ooo FROM contigs c LEFT JOIN n ON n.doc_id = c.doc_id""",
    "contigs",
    "tags",
)
def import_stats(s, d):
    tiles, stats = _tiles(s, d)
    return tiling.import_statistics(tiles, stats).select("sample", "length", "bases", "path_length", "dropped_dup", "dropped_ooo")


@query("tile_hash", "SELECT doc_id, sha256(seq) AS hash, substr(sha256(seq), 1, 13) AS prefix FROM contigs", "contigs")
def tile_hash(s, d):
    h = Q.tile_hash(F.col("seq"))
    return V.contigs(s, d).select("doc_id", h.alias("hash"), Q.hash_prefix(h).alias("prefix"))


@query("tile_hash_blake2b")
def tile_hash_blake2b(s, d):
    return V.contigs(s, d).select("doc_id", Q.blake2b_hex("seq").alias("hash"))


@query("two_bit", "SELECT tag, (strpos('acgt', substr(tagseq, 1, 1)) - 1) * 1024 + (strpos('acgt', substr(tagseq, 2, 1)) - 1) * 256 + (strpos('acgt', substr(tagseq, 3, 1)) - 1) * 64 + (strpos('acgt', substr(tagseq, 4, 1)) - 1) * 16 + (strpos('acgt', substr(tagseq, 5, 1)) - 1) * 4 + (strpos('acgt', substr(tagseq, 6, 1)) - 1) AS number, tagseq AS back FROM tags", "tags")
def two_bit(s, d):
    number = Q.two_bit(F.col("tagseq"), 6)
    return V.tags(s, d).select("tag", number.alias("number"), Q.from_two_bit(number, 6).alias("back"))


PATHS = "SELECT 'dir/' || replace(p_name, ' ', ',') || CASE p_partkey % 6 WHEN 0 THEN '.1.fa.gz' WHEN 1 THEN '.2.fasta' WHEN 2 THEN '.vcf.gz' WHEN 3 THEN '.fa' WHEN 4 THEN '.fasta.gz' ELSE '.vcf' END AS path FROM part"


def _paths(s, d):
    k = F.col("p_partkey") % 6
    end = F.when(k == 0, ".1.fa.gz").when(k == 1, ".2.fasta").when(k == 2, ".vcf.gz").when(k == 3, ".fa").when(k == 4, ".fasta.gz").otherwise(".vcf")
    return V.table(s, d, "part").select(F.concat(F.lit("dir/"), F.translate("p_name", " ", ","), end).alias("path"))


def _trim_sql(x):
    for suffix in (".gz", ".fa", ".fasta", ".1", ".2", ".gz", ".vcf"):
        x = f"regexp_replace({x}, '{suffix.replace('.', chr(92) + '.')}$', '')"
    return x


@query("label_trim", f"SELECT path, replace({_trim_sql('regexp_replace(path, ' + chr(39) + '^.*/' + chr(39) + ', ' + chr(39) * 2 + ')')}, ',', '-') AS label FROM ({PATHS})")
def label_trim(s, d):
    return _paths(s, d).select("path", Q.trim_label(F.col("path")).alias("label"))


# HGVS and exports.

EDITS = "edit AS (SELECT l_orderkey, l_linenumber, l_partkey AS position, CASE l_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'AC' ELSE 'G' END AS ref, CASE l_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'TT' ELSE 'G' END AS new, l_returnflag AS \"left\" FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem))"


def _edits(s, d):
    p, q = F.col("l_partkey") % 4, F.col("l_suppkey") % 4
    ref = F.when(p == 0, "").when(p == 1, "A").when(p == 2, "AC").otherwise("G")
    new = F.when(q == 0, "").when(q == 1, "A").when(q == 2, "TT").otherwise("G")
    rows = V.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").distinct()
    return rows.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("position"), ref.alias("ref"), new.alias("new"), F.col("l_returnflag").alias("left"))


FORMAT = "CASE WHEN ref = new AND length(ref) <= 1 THEN position::VARCHAR || '=' WHEN ref = new THEN position::VARCHAR || '_' || (position + length(ref) - 1)::VARCHAR || '=' WHEN new = '' AND length(ref) = 1 THEN position::VARCHAR || 'del' WHEN new = '' THEN position::VARCHAR || '_' || (position + length(ref) - 1)::VARCHAR || 'del' WHEN length(ref) = 1 AND length(new) = 1 THEN position::VARCHAR || ref || '>' || new WHEN ref = '' THEN (position - 1)::VARCHAR || '_' || position::VARCHAR || 'ins' || new WHEN length(ref) = 1 THEN position::VARCHAR || 'delins' || new ELSE position::VARCHAR || '_' || (position + length(ref) - 1)::VARCHAR || 'delins' || new END"


@query("hgvs_format", f"WITH {EDITS} SELECT position, ref, new, {FORMAT} AS hgvs FROM edit")
def hgvs_format(s, d):
    return _edits(s, d).select("position", "ref", "new", H.format_variant(F.col("position"), F.col("ref"), F.col("new")).alias("hgvs"))


@query("pad_left", f"WITH {EDITS} SELECT CASE WHEN ref = '' OR new = '' THEN position - length(\"left\") ELSE position END AS position, CASE WHEN ref = '' OR new = '' THEN \"left\" || ref ELSE ref END AS ref, CASE WHEN ref = '' OR new = '' THEN \"left\" || new ELSE new END AS new FROM edit")
def pad_left(s, d):
    p, r, n = H.pad_left(F.col("position"), F.col("ref"), F.col("new"), F.col("left"))
    return _edits(s, d).select(p.alias("position"), r.alias("ref"), n.alias("new"))


@query(
    "hgvs_diff_snp",
    "WITH pair AS (SELECT l_partkey AS id, translate(substr(md5(l_partkey::VARCHAR), 1, 12), '0123456789abcdef', 'ACGTACGTACGTACGT') AS a FROM (SELECT DISTINCT l_partkey FROM lineitem)) SELECT id, 6 AS position, substr(a, 6, 1) AS ref, translate(substr(a, 6, 1), 'ACGT', 'CATG') AS new, substr(a, 5, 1) AS \"left\" FROM pair",
)
def hgvs_diff_snp(s, d):
    from tesserae.functions.diff import variants_udf

    a = F.translate(F.substring(F.md5(F.col("l_partkey").cast("string")), 1, 12), "0123456789abcdef", "ACGTACGTACGTACGT")
    rows = V.table(s, d, "lineitem").select("l_partkey").distinct().select(F.col("l_partkey").alias("id"), a.alias("a"))
    b = F.concat(F.substring("a", 1, 5), F.translate(F.substring("a", 6, 1), "ACGT", "CATG"), F.substring("a", 7, 6))
    return rows.withColumn("c", F.explode(variants_udf("a", b))).select("id", "c.position", "c.ref", "c.new", "c.left")


@query("hgvs_diff")
def hgvs_diff(s, d):
    from tesserae.functions.diff import variants_udf

    seq = F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT")
    cut = (F.col("p_partkey") % 20 + 3).cast("int")
    b = F.concat(F.substring(seq, F.lit(1), cut), F.lit("GATTACA"), F.substring(seq, cut + 3, F.lit(40)))
    return V.table(s, d, "part").select("p_partkey", F.explode(variants_udf(seq, b)).alias("c")).select("p_partkey", H.format_variant(F.col("c.position"), F.col("c.ref"), F.col("c.new")).alias("hgvs"))


ALLELES = f"{EDITS}, allele AS (SELECT 'chr' || (position % 3)::VARCHAR AS seqname, position // 40 AS position, l_orderkey % 30 AS sample, l_linenumber % 2 AS phase, min(CASE WHEN position % 11 = 0 THEN '-' ELSE new END) AS new FROM edit GROUP BY 1, 2, 3, 4), full_allele AS (SELECT seqname, position, sample, phase, CASE WHEN new = '-' OR new = '' THEN '' ELSE 'T' END AS ref, new FROM allele)"


def _alleles(s, d):
    new = F.min(F.when(F.col("position") % 11 == 0, "-").otherwise(F.col("new")))
    rows = _edits(s, d).groupBy(F.concat(F.lit("chr"), (F.col("position") % 3).cast("string")).alias("seqname"), F.floor(F.col("position") / 40).alias("position"), (F.col("l_orderkey") % 30).alias("sample"), (F.col("l_linenumber") % 2).alias("phase")).agg(new.alias("new"))
    return rows.withColumn("ref", F.when(F.col("new").isin("-", ""), "").otherwise("T"))


@query("vcf_ac", f"WITH {ALLELES} SELECT seqname, position, ref, string_agg(new, ',' ORDER BY new) AS alt, 'AC=' || string_agg(n::VARCHAR, ',' ORDER BY new) AS info FROM (SELECT seqname, position, ref, new, count(*) AS n FROM full_allele WHERE new <> '-' AND NOT (ref = '' AND new = '') GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3")
def vcf_ac(s, d):
    return export.export(_alleles(s, d), "vcf")


GT = "rec AS (SELECT seqname, position, ref, list(new ORDER BY new) AS alts FROM (SELECT DISTINCT seqname, position, ref, new FROM full_allele WHERE new <> '-' AND NOT (ref = '' AND new = '')) GROUP BY 1, 2, 3), pr AS (SELECT seqname, position, sample, coalesce(max(ref) FILTER (phase = 0), '') AS ra, coalesce(max(new) FILTER (phase = 0), '') AS na, coalesce(max(ref) FILTER (phase = 1), '') AS rb, coalesce(max(new) FILTER (phase = 1), '') AS nb FROM full_allele GROUP BY 1, 2, 3)"


@query("pvcf_gt", f"WITH {ALLELES}, {GT} SELECT seqname, position, ref, array_to_string(alts, ',') AS alt, sample, (CASE WHEN ra = ref THEN coalesce(list_position(alts, na), 0) ELSE 0 END)::VARCHAR || '/' || (CASE WHEN rb = ref THEN coalesce(list_position(alts, nb), 0) ELSE 0 END)::VARCHAR AS gt FROM rec JOIN pr USING (seqname, position)")
def pvcf_gt(s, d):
    return export.export(_alleles(s, d), "pvcf")


def _text_sql(r, n):
    return FORMAT.replace("ref", r).replace("new", n)


@query("hgvs_cell", f"WITH {ALLELES}, {GT} SELECT seqname, position, sample, CASE WHEN na = '-' OR nb = '-' THEN 'N' WHEN ra = rb AND na = nb AND ra = na THEN '.' WHEN ra = rb AND na = nb THEN seqname || ':g.' || {_text_sql('ra', 'na')} ELSE seqname || ':g.[' || {_text_sql('ra', 'na')} || '];[' || {_text_sql('rb', 'nb')} || ']' END AS cell FROM pr")
def hgvs_cell(s, d):
    return export.export(_alleles(s, d), "hgvs")


DISTINCT = "v AS (SELECT DISTINCT seqname, position, ref, new FROM full_allele WHERE new <> '-' AND ref <> new)"


@query("hgvs_onehot", f"WITH {ALLELES}, {DISTINCT} SELECT v.seqname || '.' || {FORMAT.replace('position', 'v.position').replace('ref', 'v.ref').replace('new', 'v.new')} AS hgvs, a.sample, max((a.ref = v.ref AND a.new = v.new)::INT) AS value FROM v JOIN full_allele a ON a.seqname = v.seqname AND a.position = v.position GROUP BY 1, 2")
def hgvs_onehot(s, d):
    return export.export(_alleles(s, d), "hgvs-onehot")


@query("hgvs_numpy", f"WITH {ALLELES}, {GT}, {DISTINCT}, x AS (SELECT v.seqname || ':g.' || {FORMAT.replace('position', 'v.position')} AS hgvs, sample, CASE WHEN na = '-' THEN -1 WHEN ra = ref AND na = new THEN 1 ELSE 0 END AS a, CASE WHEN nb = '-' THEN -1 WHEN rb = ref AND nb = new THEN 1 ELSE 0 END AS b FROM v JOIN pr ON pr.seqname = v.seqname AND pr.position = v.position) SELECT hgvs, sample, CASE WHEN a < 0 OR b < 0 THEN -1 WHEN a = 1 AND b = 1 THEN 1 ELSE 0 END AS hom, CASE WHEN a < 0 OR b < 0 THEN -1 WHEN a <> b THEN 1 ELSE 0 END AS het FROM x")
def hgvs_numpy(s, d):
    return export.export(_alleles(s, d), "hgvs-numpy")


@query("vcf_lines", f"WITH {ALLELES} SELECT seqname, position, concat_ws(chr(9), seqname, position::VARCHAR, '.', ref, string_agg(new, ',' ORDER BY new), '.', '.', 'AC=' || string_agg(n::VARCHAR, ',' ORDER BY new)) AS value FROM (SELECT seqname, position, ref, new, count(*) AS n FROM full_allele WHERE new <> '-' AND NOT (ref = '' AND new = '') GROUP BY 1, 2, 3, 4) GROUP BY seqname, position, ref")
def vcf_lines(s, d):
    return export.vcf_lines(export.export(_alleles(s, d), "vcf"))


@query(
    "anno_vcf_merge",
    f"""WITH {EDITS}, n AS (SELECT DISTINCT 'chr' || (position % 3)::VARCHAR AS seqname, position // 20 AS position, ref, new, 'C' AS "left", (l_orderkey % 50)::INT AS tag, l_linenumber::INT AS variant, 'id' || position::VARCHAR AS hgvs FROM edit),
    r AS (SELECT seqname, CASE WHEN ref = '' OR new = '' THEN position - 1 ELSE position END AS pos, CASE WHEN ref = '' OR new = '' THEN "left" || ref ELSE ref END AS ref, CASE WHEN ref = '' OR new = '' THEN "left" || new ELSE new END AS alt, tag, variant, hgvs FROM n)
    SELECT seqname, pos, last(hgvs ORDER BY tag, variant, hgvs, ref) AS id, last(ref ORDER BY tag, variant, hgvs, ref) AS ref, alt, 'TV=,' || string_agg(tag::VARCHAR || '-' || variant::VARCHAR, ',' ORDER BY tag, variant, hgvs, ref) || ',' AS info FROM r GROUP BY seqname, pos, length(ref), alt""",
)
def anno_vcf_merge(s, d):
    rows = _edits(s, d).select(F.concat(F.lit("chr"), (F.col("position") % 3).cast("string")).alias("seqname"), F.floor(F.col("position") / 20).alias("position"), "ref", "new", F.lit("C").alias("left"), (F.col("l_orderkey") % 50).cast("int").alias("tag"), F.col("l_linenumber").cast("int").alias("variant"), F.concat(F.lit("id"), F.col("position").cast("string")).alias("hgvs"))
    return annotate.annotation_records(rows.distinct())


@query("annotation_rates", "SELECT event_type AS seqname, count(*) AS n, round(avg(CASE WHEN event_id % 3 <> 0 THEN 100.0 ELSE 0.0 END), 6) AS rsid_rate, round(avg(CASE WHEN value > 20 THEN 100.0 ELSE 0.0 END), 6) AS af_rate FROM events GROUP BY ROLLUP (event_type)")
def annotation_rates(s, d):
    rows = V.table(s, d, "events").select(F.col("event_type").alias("seqname"), F.when(F.col("event_id") % 3 != 0, F.lit("rs")).alias("rsid"), F.when(F.col("value") > 20, F.col("value")).alias("af"))
    return annotate.hit_rates(rows)


@query(
    "spanning_candidates",
    """WITH s AS (SELECT tag, coalesce(lead(tag) OVER (PARTITION BY seqname ORDER BY pos, tag), -1) AS next_tag, tag % 4 = 0 AS excluded FROM placed)
    SELECT c.tag, c.hash AS seq FROM counts c JOIN s USING (tag) WHERE NOT excluded OR NOT coalesce(c.hash LIKE '%' || (next_tag % 3)::VARCHAR, true) AND next_tag >= 0""",
    "placed",
    "counts",
)
def spanning_candidates(s, d):
    tiles = reference.successors(_placed(s, d)).select("tag", "next_tag", (F.col("tag") % 4 == 0).alias("excluded"))
    tags = V.calls(s, d).select("tag").distinct().withColumn("tagseq", (F.col("tag") % 3).cast("string"))
    return filters.spanning_candidates(_counts(s, d).select("tag", F.col("hash").alias("seq")), tiles, tags)


@query(
    "reference_rows",
    f"WITH {NOTES} SELECT DISTINCT note.tag, 7 AS outcol, rv AS variant, '=' AS hgvs, 'c' AS seqname, length(note.hgvs)::BIGINT AS position, 'A' AS ref, 'A' AS new, 'T' AS \"left\" FROM note JOIN rv ON rv.tag = note.tag WHERE hgvs NOT IN ('', '=') AND variant < 3",
    "numbered",
    "ref",
)
def reference_rows(s, d):
    notes = _notes(s, d).where("variant < 3").select("tag", F.lit(7).alias("outcol"), "variant", "hgvs", F.lit("c").alias("seqname"), F.length("hgvs").cast("long").alias("position"), F.lit("A").alias("ref"), F.lit("C").alias("new"), F.lit("T").alias("left"))
    return annotate.reference_rows(notes, _ref_variants(s, d)).distinct()


# Variant files.


def _records(s, d):
    """Records shaped like a VCF's, from lineitem."""
    rows = V.table(s, d, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax").distinct()
    k = F.col("l_partkey")
    alt = F.when(k % 9 == 0, ".").when(k % 9 == 1, "G,<NON_REF>").when(k % 9 == 2, "*").when(k % 9 == 3, "A").otherwise("T")
    gt = F.when(k % 5 == 0, "1").when(k % 5 == 1, "0|0").when(k % 5 == 2, "1/2").when(k % 5 == 3, "./.").otherwise("1/1")
    fmt = F.when(k % 4 == 0, "GT").otherwise("GT:GQ")
    sample = F.concat(gt, F.when(k % 4 == 0, "").when(k % 4 == 1, ":.").otherwise(F.concat(F.lit(":"), F.col("l_quantity").cast("int").cast("string"))))
    info = F.when(k % 3 == 0, F.concat(F.lit("END="), (k + 5).cast("string"), F.lit(".;DP=3"))).when(k % 3 == 1, "IMP;AF=0.5").otherwise("DP=7")
    out = rows.select(F.concat(F.lit("chr"), F.col("l_returnflag")).alias("chrom"), k.alias("pos"), F.lit(".").alias("id"), F.lit("A").alias("ref"), alt.alias("alt"), F.col("l_quantity").alias("qual"), F.when(k % 2 == 0, "PASS").otherwise("LOW").alias("filter"), info.alias("info"), fmt.alias("format"), sample.alias("sample"), "l_suppkey", "l_linenumber", "l_tax")
    return out.withColumn("line", F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "id", "ref", "alt", F.col("qual").cast("int").cast("string"), "filter", "info", "format", "sample"))


RECORDS = """rec AS (SELECT *, concat_ws(chr(9), chrom, pos::VARCHAR, id, ref, alt, qual::INT::VARCHAR, filter, info, format, sample) AS line FROM (SELECT 'chr' || l_returnflag AS chrom, l_partkey AS pos, '.' AS id, 'A' AS ref, CASE l_partkey % 9 WHEN 0 THEN '.' WHEN 1 THEN 'G,<NON_REF>' WHEN 2 THEN '*' WHEN 3 THEN 'A' ELSE 'T' END AS alt, l_quantity AS qual, CASE WHEN l_partkey % 2 = 0 THEN 'PASS' ELSE 'LOW' END AS filter, CASE l_partkey % 3 WHEN 0 THEN 'END=' || (l_partkey + 5)::VARCHAR || '.;DP=3' WHEN 1 THEN 'IMP;AF=0.5' ELSE 'DP=7' END AS info, CASE WHEN l_partkey % 4 = 0 THEN 'GT' ELSE 'GT:GQ' END AS format, CASE l_partkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '0|0' WHEN 2 THEN '1/2' WHEN 3 THEN './.' ELSE '1/1' END || CASE l_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ':.' ELSE ':' || l_quantity::INT::VARCHAR END AS sample, l_suppkey, l_linenumber, l_tax FROM (SELECT DISTINCT l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_tax FROM lineitem)))"""
COLS = "chrom, pos, alt, qual, info, sample, l_suppkey, l_linenumber"
PICK = [c.strip() for c in COLS.split(",")]
GQ = "try_cast(CASE WHEN pos % 4 = 0 THEN NULL ELSE split_part(sample, ':', 2) END AS DOUBLE)"


@query("gvcf_called", f"WITH {RECORDS} SELECT chrom, pos, sample, coalesce({GQ}, 0) >= 5 AND qual >= 10 AND line LIKE '%PASS%' AND split_part(sample, ':', 1) NOT LIKE '%.%' AS called, l_suppkey, l_linenumber FROM rec")
def gvcf_called(s, d):
    return _records(s, d).select("chrom", "pos", "sample", vcf.is_called(5, 10, ("PASS",)).alias("called"), "l_suppkey", "l_linenumber")


@query("ignore_phrases", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE line NOT LIKE '%IMP%' AND line NOT LIKE '%LOW%'")
def ignore_phrases(s, d):
    return _records(s, d).where(vcf.considered(("IMP", "LOW"))).select(PICK)


@query("gvcf_bed_interval", f"WITH {RECORDS} SELECT chrom, greatest(pos - 1, 0) AS \"start\", CASE WHEN pos % 3 = 0 THEN pos + 5 ELSE greatest(pos - 1, 0) + 1 END AS \"end\", l_suppkey, l_linenumber FROM rec")
def gvcf_bed_interval(s, d):
    start, end = vcf.bed_interval()
    return _records(s, d).withColumn("info", vcf.fix_end(F.col("info"))).select("chrom", start.alias("start"), end.alias("end"), "l_suppkey", "l_linenumber")


@query("filter_gq", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE pos % 4 = 0 OR (pos % 4 <> 1 AND {GQ} >= 20)")
def filter_gq(s, d):
    return vcf.filter_gq(_records(s, d), 20).select(PICK)


@query("filter_gq_keep", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE pos % 4 IN (0, 1) OR {GQ} >= 20")
def filter_gq_keep(s, d):
    return vcf.filter_gq(_records(s, d), 20, keep_missing=True).select(PICK)


@query("filter_quality", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE qual >= 15 AND coalesce({GQ}, 0) >= 20")
def filter_quality(s, d):
    return vcf.filter_quality(_records(s, d), 15, 20).select(PICK)


@query("variants_only", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE line NOT LIKE '%*%' AND line NOT LIKE '%<NON_REF>%' AND alt <> '.'")
def variants_only(s, d):
    return vcf.variants_only(_records(s, d)).select(PICK)


@query("ref_differs", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE ref <> alt")
def ref_differs(s, d):
    return vcf.ref_differs(_records(s, d)).select(PICK)


@query("imputed_records", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE line LIKE '%IMP%' AND line NOT LIKE '%0|0%'")
def imputed_records(s, d):
    return vcf.imputed(_records(s, d)).select(PICK)


@query("phased_records", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE line NOT LIKE '%IMP%' AND line NOT LIKE '%0|0%'")
def phased_records(s, d):
    return vcf.phased(_records(s, d)).select(PICK)


@query("diploid_genotypes", f"WITH {RECORDS} SELECT chrom, pos, alt, qual, info, CASE WHEN pos % 5 = 0 THEN '1/' || sample ELSE sample END AS sample, l_suppkey, l_linenumber FROM rec")
def diploid_genotypes(s, d):
    return vcf.diploid(_records(s, d)).select(PICK)


@query("mitochondrial_genotypes", f"WITH {RECORDS} SELECT chrom, pos, alt, qual, info, CASE WHEN pos % 5 = 0 THEN '1/' || sample ELSE sample END AS sample, l_suppkey, l_linenumber FROM (SELECT * REPLACE (CASE WHEN chrom = 'chrA' THEN 'chrM' ELSE chrom END AS chrom) FROM rec) WHERE chrom <> 'chrM' OR pos % 5 <> 2")
def mitochondrial_genotypes(s, d):
    return vcf.mitochondrial(_records(s, d).withColumn("chrom", F.when(F.col("chrom") == "chrA", "chrM").otherwise(F.col("chrom")))).select(PICK)


@query("real_alleles", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE alt NOT LIKE '%,%' OR NOT list_contains(string_split(replace(split_part(sample, ':', 1), '|', '/'), '/'), '2')")
def real_alleles(s, d):
    return vcf.real_alleles(_records(s, d)).select(PICK)


@query("fix_end", f"WITH {RECORDS} SELECT chrom, pos, replace(info, '.;DP', ';DP') AS info, l_suppkey, l_linenumber FROM rec")
def fix_end(s, d):
    return _records(s, d).select("chrom", "pos", vcf.fix_end(F.col("info")).alias("info"), "l_suppkey", "l_linenumber")


@query("drop_info", f"WITH {RECORDS} SELECT chrom, pos, CASE pos % 3 WHEN 0 THEN 'END=' || (pos + 5)::VARCHAR || '.' WHEN 1 THEN 'AF=0.5' ELSE '.' END AS info, l_suppkey, l_linenumber FROM rec")
def drop_info(s, d):
    return _records(s, d).select("chrom", "pos", vcf.drop_info(F.col("info"), ("DP", "IMP")).alias("info"), "l_suppkey", "l_linenumber")


@query("freq_left_join", f"WITH {RECORDS} SELECT chrom, pos, alt, CASE WHEN alt = 'T' AND pos % 7 = 0 AND ref = 'A' THEN 'rs' || pos::VARCHAR ELSE '.' END AS id, CASE WHEN alt = 'T' AND pos % 7 = 0 THEN 0.25::DOUBLE END AS af, l_suppkey, l_linenumber FROM rec")
def freq_left_join(s, d):
    rows = _records(s, d)
    known = rows.where("alt = 'T' and pos % 7 = 0").select("chrom", "pos", "ref", "alt").distinct().withColumn("rsid", F.concat(F.lit("rs"), F.col("pos").cast("string"))).withColumn("af", F.lit(0.25).cast("double"))
    return vcf.with_known_ids(rows, known).select("chrom", "pos", "alt", "id", "af", "l_suppkey", "l_linenumber")


@query("vcf_eval", f"WITH {RECORDS}, a AS (SELECT DISTINCT chrom, pos, ref, alt FROM rec WHERE l_suppkey % 2 = 0), b AS (SELECT DISTINCT chrom, pos, ref, alt FROM rec WHERE l_linenumber % 2 = 0) SELECT chrom, pos, ref, alt, CASE WHEN y IS NULL THEN 'FN' WHEN x IS NULL THEN 'FP' ELSE 'TP' END AS status FROM (SELECT *, 1 AS x FROM a) FULL JOIN (SELECT *, 1 AS y FROM b) USING (chrom, pos, ref, alt)")
def vcf_eval(s, d):
    rows = _records(s, d)
    return vcf.compare(rows.where("l_suppkey % 2 = 0"), rows.where("l_linenumber % 2 = 0"))


@query("vcf_merge", f"WITH {RECORDS}, f AS (SELECT chrom, pos, ref, alt, min(qual) AS qual, 0 AS k FROM rec WHERE l_suppkey % 2 = 0 GROUP BY 1, 2, 3, 4 UNION ALL SELECT chrom, pos, ref, alt, max(qual), 1 FROM rec WHERE l_suppkey % 2 = 1 GROUP BY 1, 2, 3, 4) SELECT chrom, pos, ref, alt, arg_min(qual, k) AS qual FROM f GROUP BY 1, 2, 3, 4")
def vcf_merge(s, d):
    rows = _records(s, d)
    a = rows.where("l_suppkey % 2 = 0").groupBy("chrom", "pos", "ref", "alt").agg(F.min("qual").alias("qual"))
    b = rows.where("l_suppkey % 2 = 1").groupBy("chrom", "pos", "ref", "alt").agg(F.max("qual").alias("qual"))
    return vcf.merge_records(a, b)


@query("vcf_concat", f"WITH {RECORDS} SELECT {COLS} FROM rec WHERE chrom IN ('chrR', 'chrA')")
def vcf_concat(s, d):
    return vcf.concat_chromosomes(_records(s, d), ["chrR", "chrA"]).select(PICK)


# Samples.


@query("pattern_join", "SELECT c_name AS name, s_suppkey % 10 AS status, lpad(s_suppkey::VARCHAR, 4, '0') AS pattern FROM customer JOIN supplier ON contains(c_name, lpad(s_suppkey::VARCHAR, 4, '0'))")
def pattern_join(s, d):
    names = V.table(s, d, "customer").select(F.col("c_name").alias("name"))
    patterns = V.table(s, d, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 4, "0").alias("pattern"), (F.col("s_suppkey") % 10).alias("status"))
    return people.match_patterns(names, patterns)


def _patterns(s, d):
    return V.table(s, d, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 3, "0").alias("pattern"), (F.col("s_suppkey") % 3).cast("string").alias("status"))


def _names(s, d):
    return V.table(s, d, "customer").select(F.col("c_name").alias("name"))


FOUND = "found AS (SELECT c_name AS name, count(*) AS n, max((s_suppkey % 3)::VARCHAR) AS status FROM customer JOIN supplier ON contains(c_name, lpad(s_suppkey::VARCHAR, 3, '0')) GROUP BY 1)"


@query("case_control_dedup", f"WITH {FOUND} SELECT c_name AS name, CASE WHEN n = 1 AND status IN ('0', '1') THEN status::INT END AS case_control FROM customer LEFT JOIN found ON name = c_name")
def case_control_dedup(s, d):
    return people.case_control(_names(s, d), _patterns(s, d))


@query("case_flags", f"WITH {FOUND} SELECT c_name AS name, n IS NOT NULL AS is_case, coalesce(n, 0) AS n FROM customer LEFT JOIN found ON name = c_name")
def case_flags(s, d):
    return people.case_flags(_names(s, d), _patterns(s, d))


@query("phenotype", "SELECT c_name AS name, max_by(s_name, s_suppkey) AS value FROM customer LEFT JOIN supplier ON contains(c_name, lpad(s_suppkey::VARCHAR, 3, '0')) GROUP BY 1")
def phenotype(s, d):
    rows = V.table(s, d, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 3, "0").alias("pattern"), F.col("s_suppkey").alias("line"), F.col("s_name").alias("value"))
    return people.phenotype(_names(s, d).distinct(), rows)


@query("train_split", "WITH e AS (SELECT c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey % 2)::INT END AS case_control FROM customer), r AS (SELECT name, row_number() OVER (ORDER BY md5(name), name) AS i, count(*) OVER () AS n FROM e WHERE case_control IS NOT NULL) SELECT e.name, case_control, CASE WHEN i IS NULL THEN NULL WHEN i <= trunc(0.8::DOUBLE * n) THEN 1 ELSE 0 END AS training FROM e LEFT JOIN r USING (name)")
def train_split(s, d):
    rows = V.table(s, d, "customer").select(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 != 0, (F.col("c_custkey") % 2).cast("int")).alias("case_control"))
    return people.training_split(rows, 0.8, order=F.md5("name"))


@query("batch_slice", "SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS n FROM part) WHERE i // ceil(n / 7)::BIGINT = 3")
def batch_slice(s, d):
    return people.batch(V.table(s, d, "part").select("p_partkey"), 7, 3, "p_partkey")


@query("fixed_batches", "SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 12 AS batch FROM part")
def fixed_batches(s, d):
    return people.fixed_batches(V.table(s, d, "part").select("p_partkey"), 12, "p_partkey")


@query("param_cross", "SELECT r_name, n_name FROM region CROSS JOIN nation")
def param_cross(s, d):
    return vcf.parameter_grid(V.table(s, d, "region").select("r_name"), V.table(s, d, "nation").select("n_name"))


@query("match_chromosome", "SELECT DISTINCT name FROM (SELECT 'chr' || CASE p_size % 30 WHEN 23 THEN 'X' WHEN 24 THEN 'MT' WHEN 25 THEN '1_alt' ELSE (p_size % 30)::VARCHAR END AS name FROM part) WHERE regexp_matches(name, '^(chr)?([0-9]+|X|Y|MT?)$')")
def match_chromosome(s, d):
    k = F.col("p_size") % 30
    rows = V.table(s, d, "part").select(F.concat(F.lit("chr"), F.when(k == 23, "X").when(k == 24, "MT").when(k == 25, "1_alt").otherwise(k.cast("string"))).alias("seqname"))
    return filters.match_chromosome(rows).select(F.col("seqname").alias("name")).distinct()


@query("region_lines", "SELECT regexp_replace(n_name, '^chr', '') AS seqname, (n_nationkey * 10 - 5)::BIGINT AS \"start\", (n_nationkey * 10 + 25)::BIGINT AS \"end\" FROM nation WHERE n_nationkey % 4 < 2 UNION ALL SELECT n_name, (n_nationkey * 10 - 5)::BIGINT, (n_nationkey * 10 + 26)::BIGINT FROM nation WHERE n_nationkey % 4 = 2")
def region_lines(s, d):
    from tesserae.sources.readers import parse_regions

    k = F.col("n_nationkey")
    a, b = (k * 10).cast("string"), (k * 10 + 20).cast("string")
    line = F.when(k % 4 < 2, F.concat_ws("\t", F.concat(F.lit("chr"), "n_name"), a, b, F.lit("x"))).when(k % 4 == 2, F.concat_ws("\t", "n_name", F.lit("src"), F.lit("gene"), a, b)).otherwise(F.concat(F.lit("#"), "n_name"))
    return parse_regions(V.table(s, d, "nation").select(line.alias("value")), 5)


# The same over views that grow with the tables: a tag for each part, about a call for each line.


def _wide(name):
    """Register a query over wide views; its SQL is that of the narrow one, ``name``."""

    def add(fn):
        QUERIES[f"wide_{name}"] = fn
        ORACLE[f"wide_{name}"] = ORACLE[name].replace("l_partkey % 200 AS tag", "l_partkey AS tag")
        return fn

    return add


def _wide_ranked(s, d):
    return library.rank_variants(library.allele_counts(V.calls(s, d, True), V.ref_tiles(s, d, True)))


def _wide_carriers(s, d):
    return matrix.genotypes(library.renumber(V.calls(s, d, True), _wide_ranked(s, d)))


@_wide("variant_rank")
def wide_variant_rank(s, d):
    return _wide_ranked(s, d)


@_wide("tile_matrix_long")
def wide_tile_matrix_long(s, d):
    return matrix.matrix_cells(V.calls(s, d, True), _wide_ranked(s, d))


@_wide("chi2_scan")
def wide_chi2_scan(s, d):
    scan = association.chi2_scan(_wide_carriers(s, d), V.samples(s, d))
    return scan.select("tag", "variant", "hom", "a", "b", F.round("maf", 6).alias("maf"), F.round("statistic", 6).alias("statistic"))


@_wide("onehot_coo")
def wide_onehot_coo(s, d):
    carriers = _wide_carriers(s, d)
    columns = matrix.numbered_columns(matrix.homhet_columns(carriers))
    return matrix.coordinates(carriers, columns, V.samples(s, d).select("sample", F.col("sample").alias("idx")))


@_wide("filter_max_variants")
def wide_filter_max_variants(s, d):
    return filters.max_variants(V.calls(s, d, True), 17)
