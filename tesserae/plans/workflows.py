"""Workflows: operators chained as a study uses them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.operators import annotate, association, export, filters, intervals, library, matrix, pca, reference, samples as people, tiling, variants as vcf
from tesserae.functions.sequences import chromosome_order
from tesserae.session import materialize


@dataclass
class Library:
    """A tile library with its reference."""

    tags: DataFrame  # tag, tagseq
    variants: DataFrame  # tag, hash, seq, is_ref
    calls: DataFrame  # sample, tag, phase, hash, known
    ref_tiles: DataFrame  # seqname, step, tag, hash, seq, len, pos
    ref_seqs: DataFrame  # seqname, seq
    k: int = tiling.TAG_LENGTH


def build_library(contigs: DataFrame, ref: DataFrame, tags: DataFrame, k: int = tiling.TAG_LENGTH, chromosomes: str = "", skip_out_of_order: bool = False) -> Library:
    """Tile the haplotypes (sample, phase, seqname, seq) and the reference (seqname, seq)."""
    own = contigs.select("sample", "phase", "seqname", "seq")
    own_ref = ref.select(F.lit("ref").alias("sample"), F.lit(0).alias("phase"), "seqname", "seq")
    if chromosomes:
        own, own_ref = filters.match_chromosome(own, chromosomes), filters.match_chromosome(own_ref, chromosomes)
    tiles = materialize(tiling.tile_contigs(own, tags, k, skip_out_of_order=skip_out_of_order)[0], "tiles")
    ref_tiles = materialize(tiling.tile_contigs(own_ref, tags, k)[0], "reference")
    ref_tiles = ref_tiles.select("seqname", "step", "tag", F.sha2("seq", 256).alias("hash"), "seq", F.length("seq").cast("long").alias("len"), F.col("start").alias("pos"))
    placed = reference.without_inner_tags(reference.unique_tiles(ref_tiles), tags, k)
    variants = library.merge_libraries(tiling.variants_of(tiles), tiling.variants_of(ref_tiles.select("tag", "seq"), True))
    return Library(tags, variants, tiling.calls_of(tiles), placed, ref.select("seqname", F.lower("seq").alias("seq")), k)


def ranked_variants(lib: Library, counted=None) -> DataFrame:
    return library.rank_variants(library.allele_counts(lib.calls, lib.ref_tiles.where(~F.col("seq").rlike("[^acgt]")), counted))


def compared_variants(lib: Library, max_size: int = 50_000) -> DataFrame:
    """Each distinct known variant beside the reference it stands against, with its changes."""
    known = lib.variants.where("seq is not null").select("tag", "hash", "seq")
    pairs = annotate.spanned_reference(known, lib.ref_tiles, lib.tags, lib.ref_seqs, lib.k)
    return annotate.differences(pairs, max_size)


def tile_matrix(lib: Library, regions: DataFrame | None = None, expand: int = 0, coverage: float = 0.0, n_samples: int = 0) -> tuple[DataFrame, DataFrame]:
    """(cells, annotations) of the tiles in ``regions`` (all if none), with output columns."""
    tiles = lib.ref_tiles
    if regions is not None:
        wide = regions.select("seqname", (F.col("start") - expand).alias("start"), (F.col("end") + expand).alias("end"))
        spans = tiles.withColumn("start", F.col("pos")).withColumn("end", F.col("pos") + F.col("len")).withColumn("_name", F.col("seqname")).withColumn("seqname", F.regexp_replace("seqname", "^chr", ""))
        tiles = intervals.semi_join(spans, wide).withColumn("seqname", F.col("_name")).drop("_name", "start", "end")
    ranked = ranked_variants(lib)
    columns = matrix.output_columns(tiles)
    calls = lib.calls.join(columns.select("tag"), "tag", "left_semi")
    kept = filters.min_coverage(calls, coverage, n_samples, "matrix").select("tag").distinct() if coverage > 0 else None
    cells = matrix.matrix_cells(calls, ranked, kept)
    notes = annotate.annotations(ranked, compared_variants(lib), lib.ref_tiles, columns)
    return cells, notes


def export_variants(lib: Library, fmt: str = "hgvs") -> DataFrame:
    """Variants of all samples by position in a registered format."""
    alleles = export.alleles_of(lib.calls, compared_variants(lib).where("changes is not null"))
    if fmt in ("vcf", "pvcf"):
        alleles = export.padded(alleles)
    return export.export(alleles, fmt)


def association_study(lib: Library, patterns: DataFrame | None, training: float = 0.8, components: int = 0, low: float = 0.01, high: float = 1.0, below: float = 1.0) -> DataFrame:
    """Choose samples, find components if asked to, and test hom and het columns by chi-square or by the
    likelihood ratio with components; the points of a Manhattan plot."""
    names = lib.calls.select(F.col("sample").alias("name")).distinct()
    chosen = people.numbered(people.training_split(people.case_control(names, patterns), training))
    samples = materialize(chosen.select(F.col("name").alias("sample"), F.col("idx").cast("long").alias("idx"), (F.col("case_control") == 1).alias("is_case"), F.coalesce(F.col("training") == 1, F.lit(False)).alias("is_training")), "samples")
    carriers = materialize(matrix.genotypes(library.renumber(lib.calls, ranked_variants(lib))), "carriers")
    if components:
        columns = matrix.numbered_columns(matrix.homhet_columns(carriers))
        scored = pca.pca(matrix.coordinates(carriers, columns, samples.select("sample", "idx")), samples, components)
        scan = association.glm_scan(carriers, scored, low, high)
        scan = scan if below >= 1 else scan.where(F.col("pvalue") < below)
    else:
        scan = association.with_pvalue(association.chi2_scan(carriers, samples, low, high), below)
    return association.manhattan_points(scan, lib.ref_tiles)


def haplotypes_from_gvcf(ref: DataFrame, records: DataFrame, preset: str = "gatk", masked: bool = True) -> DataFrame:
    """Haplotype contigs of the samples of gVCF records (with ``sample_id``): variants put in, uncalled stretches n."""
    sizes = ref.select("seqname", F.length("seq").cast("long").alias("size"))
    gt = vcf.format_field("GT").alias("gt")
    real = vcf.variants_only(records).select("sample_id", "chrom", "pos", "ref", "alt", gt)
    mask = None
    if masked:
        # each sample's contigs by names of their own
        own = F.concat(F.col("sample_id").cast("string"), F.lit("\t"))
        called = intervals.called_regions(vcf.gvcf_blocks(records.withColumn("chrom", F.concat(own, "chrom")), preset), vcf.PRESETS[preset]["unreported_called"])
        every = records.select("sample_id").distinct().crossJoin(sizes).select("sample_id", "seqname", F.concat(own, "seqname").alias("name"), "size")
        gaps = intervals.complement(called, every.select(F.col("name").alias("seqname"), "size"))
        mask = gaps.withColumnRenamed("seqname", "name").join(every.drop("size"), "name").select("sample_id", "seqname", "start", "end")
    return vcf.consensus(ref, real, mask)


def clean_gvcf(records: DataFrame, cutoff: int, keep_missing: bool = False) -> DataFrame:
    """Records of sufficient GQ, without those that overlap one kept before."""
    kept = vcf.filter_gq(records, cutoff, keep_missing)
    start, end = vcf.bed_interval()
    placed = kept.withColumn("start", start).withColumn("end", end)
    return intervals.drop_overlapping(placed, "chrom").drop("start", "end")


def merge_phased_imputed(records: DataFrame, regions: DataFrame) -> DataFrame:
    """Phased records as they are, and imputed ones that lie in the regions without calls, by allele."""
    imputed = vcf.imputed(records)
    start, end = vcf.bed_interval()
    spans = imputed.withColumn("seqname", F.col("chrom")).withColumn("start", start).withColumn("end", end)
    inside = intervals.contained(spans, regions).drop("seqname", "start", "end")
    return vcf.merge_records(vcf.phased(records), inside)


def annotate_records(records: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with known ids and frequencies, and the rates at which they have them."""
    found = vcf.with_known_ids(vcf.ref_differs(records), known)
    return found, annotate.hit_rates(found, "chrom")


def vcf_and_bed_to_gvcf(records: DataFrame, called: DataFrame) -> DataFrame:
    """gVCF rows, in natural order, of variants inside the called regions and of called stretches without one."""
    start, end = vcf.bed_interval()
    spans = records.withColumn("seqname", F.col("chrom")).withColumn("start", start).withColumn("end", end)
    inside = intervals.contained(spans, called).drop("seqname", "start", "end")
    return vcf.hom_ref_fill(called, inside).orderBy(*chromosome_order(F.col("chrom")), "pos")


def compare_calls(baseline: DataFrame, calls: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Counts of TP, FP and FN alleles outside of the excluded regions."""

    def inside(rows):
        rows = vcf.ref_differs(rows)
        if excluded is None:
            return rows
        spans = rows.withColumn("seqname", F.col("chrom")).withColumn("start", F.col("pos") - 1).withColumn("end", F.col("pos") - 1 + F.length("ref"))
        return intervals.semi_join(spans, excluded, closed=False, how="left_anti").drop("seqname", "start", "end")

    return vcf.compare(inside(baseline), inside(calls)).groupBy("status").agg(F.count("*").alias("n"))


def gvcf_to_haplotypes(ref: DataFrame, files: list[DataFrame], preset: str = "gatk", masked: bool = True, chromosomes: list[str] | None = None, non_ref: bool = False, imputed_regions: DataFrame | None = None) -> DataFrame:
    """Haplotypes of gVCF records (with ``sample_id``) that come in one file or in one for each chromosome.

    ``chromosomes`` are the ones to keep; ``non_ref`` drops genotypes that name the placeholder allele; with
    ``imputed_regions`` the records are phased and imputed ones, and the latter count in these regions alone.
    """
    records = reduce(DataFrame.unionByName, files)
    if chromosomes:
        records = records.where(F.col("chrom").isin(chromosomes))
    if non_ref:
        records = vcf.real_alleles(records)
    if imputed_regions is not None:
        own = [merge_phased_imputed(part.drop("sample_id"), imputed_regions).withColumn("sample_id", F.lit(name)) for name, part in _by_sample(records)]
        records = reduce(DataFrame.unionByName, own)
    return haplotypes_from_gvcf(ref, records, preset, masked)


def _by_sample(records: DataFrame, most: int = 10_000) -> list[tuple[str, DataFrame]]:
    """Records of each sample; more than ``most`` samples are refused."""
    names = sorted(r.sample_id for r in records.select("sample_id").distinct().limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"there are more than {most} samples")
    return [(n, records.where(F.col("sample_id") == n)) for n in names]


def prepare_imputation(records: DataFrame, excluded: DataFrame) -> DataFrame:
    """Records that start outside of the excluded regions, in natural order, as a phasing program takes them."""
    spans = records.withColumn("seqname", F.col("chrom")).withColumn("start", F.col("pos") - 1).withColumn("end", F.col("pos") - 1 + F.length("ref"))
    kept = intervals.semi_join(spans, excluded, closed=False, how="left_anti").drop("seqname", "start", "end")
    return kept.orderBy(*chromosome_order(F.col("chrom")), "pos")


def imputation_to_matrix(ref: DataFrame, records: DataFrame, regions: DataFrame, tags: DataFrame, k: int = tiling.TAG_LENGTH) -> tuple[DataFrame, DataFrame]:
    """(cells, annotations) of the tile matrix of phased and imputed records (with ``sample_id``)."""
    contigs = gvcf_to_haplotypes(ref, [records], masked=False, imputed_regions=regions).withColumn("seq", F.lower("seq"))
    return tile_matrix(build_library(contigs, ref, tags, k))


def study_by_batches(batches: list[DataFrame], ref: DataFrame, tags: DataFrame, patterns: DataFrame | None = None, k: int = tiling.TAG_LENGTH, **options) -> tuple[Library, DataFrame]:
    """(library, points): contigs imported batch by batch, put together, and tested for association (``association_study``)."""
    libs = [build_library(b, ref, tags, k) for b in batches]
    whole = libs[0]
    whole.variants = library.merge_libraries(*(x.variants for x in libs))
    whole.calls = reduce(DataFrame.unionByName, [x.calls for x in libs])
    return whole, association_study(whole, patterns, **options)


def matrices(lib: Library, genomes: list[str], regions: dict[str, DataFrame]) -> dict[tuple[str, str], tuple[DataFrame, DataFrame]]:
    """(cells, annotations) for every pattern of genomes with every set of regions; lists of parameters are short."""
    if len(genomes) * len(regions) > 10_000:
        raise ValueError("there are more than 10000 combinations")
    out = {}
    for pattern in genomes:
        own = Library(lib.tags, lib.variants, filters.match_genome(lib.calls, pattern), lib.ref_tiles, lib.ref_seqs, lib.k)
        for name, spans in regions.items():
            out[pattern, name] = tile_matrix(own, spans)
    return out


def annotated_variants(lib: Library, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rates): the tile variants' changes as VCF records, with ids and frequencies of known alleles."""
    records = annotate.annotation_records(tile_matrix(lib)[1]).withColumnRenamed("seqname", "chrom")
    return annotate_records(records, known)


def portable_records(records: DataFrame, dropped: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(records, counts): sorted, without overlaps and without the INFO keys ``dropped``, and how the alleles compare with before."""
    start, end = vcf.bed_interval()
    clean = intervals.drop_overlapping(records.withColumn("start", start).withColumn("end", end), "chrom").drop("start", "end")
    out = clean.withColumn("info", vcf.drop_info(F.col("info"), dropped)).orderBy(*chromosome_order(F.col("chrom")), "pos")
    return out, compare_calls(records, out)


def called_records(records: DataFrame, preset: str = "complete_genomics") -> tuple[DataFrame, DataFrame]:
    """(records, regions): INFO repaired, called regions by the caller's settings, and the variants that lie in them."""
    fixed = records.withColumn("info", vcf.fix_end(F.col("info")))
    regions = materialize(intervals.called_regions(vcf.gvcf_blocks(fixed, preset), vcf.PRESETS[preset]["unreported_called"]), "called")
    start, end = vcf.bed_interval()
    real = vcf.variants_only(fixed)
    spans = real.withColumn("seqname", F.col("chrom")).withColumn("start", start).withColumn("end", end)
    return intervals.contained(spans, regions).drop("seqname", "start", "end"), regions


def good_records(records: DataFrame, least_qual: float, least_gq: float) -> tuple[DataFrame, DataFrame]:
    """(records, regions): records of sufficient quality, and the union of the stretches they cover."""
    good = vcf.filter_quality(records, least_qual, least_gq)
    start, end = vcf.bed_interval()
    return good, intervals.merge(good.select(F.col("chrom").alias("seqname"), start.alias("start"), end.alias("end")))


def repaired_records(files: list[DataFrame], chromosomes: list[str]) -> DataFrame:
    """Files of single chromosomes as one, in the order of ``chromosomes``, haploid genotypes and those of the mitochondrion
    and of the placeholder allele repaired or left out."""
    return vcf.concat_chromosomes(vcf.mitochondrial(vcf.real_alleles(reduce(DataFrame.unionByName, files))), chromosomes)
