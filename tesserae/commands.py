"""The commands of a tiling study, over Parquet libraries and Spark paths.

``COMMANDS`` maps names to functions of a session and keyword options; ``python -m tesserae NAME --option=value``
runs one. A library directory holds tags, variants, calls, ref_tiles and ref_seqs.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.functions.diff import variants_udf
from tesserae.functions.hgvs import genomic
from tesserae.operators import annotate, association, filters, intervals, library, matrix, pca, reference, samples as people, variants as vcf
from tesserae.plans import workflows
from tesserae.plans.workflows import Library
from tesserae.sources import readers, writers

COMMANDS: dict = {}


def command(name: str):
    def add(fn):
        COMMANDS[name] = fn
        return fn

    return add


def load(spark: SparkSession, path: str) -> Library:
    parts = {n: spark.read.parquet(f"{path}/{n}") for n in ("tags", "variants", "calls", "ref_tiles", "ref_seqs")}
    return Library(**{n: df.drop("chunk") for n, df in parts.items()})


def save(lib: Library, path: str, tags_per_file: int = 50_000) -> None:
    writers.write_library(path, tags_per_file, tags=lib.tags, variants=lib.variants, calls=lib.calls, ref_tiles=lib.ref_tiles, ref_seqs=lib.ref_seqs)


def _merged(libs: list[Library]) -> Library:
    """One library of several, which must have the same tags."""
    first = libs[0]
    for other in libs[1:]:
        if not library.same_tags(first.tags, other.tags):
            raise ValueError("the libraries' tag sets differ")
    if len(libs) > 1:
        first.variants = library.merge_libraries(*(x.variants for x in libs))
        first.calls = reduce(DataFrame.unionByName, [x.calls for x in libs])
    return first


def _filtered(lib: Library, max_variants: int = -1, min_coverage: float = 0, max_tag: int = -1, match_genome: str = "") -> Library:
    n = lib.calls.select("sample").distinct().count()
    lib.calls = filters.apply(lib.calls, n, max_variants, min_coverage, max_tag, match_genome)
    return lib


@command("ref2genome")
def ref2genome(spark, ref: str, output: str) -> None:
    """Lengths of the contigs of a FASTA file, as label and length."""
    lengths = readers.read_fasta(spark, ref).groupBy("seqname").agg(F.sum(F.length("seq")).alias("n"))
    writers.write_lines(lengths.select(F.concat_ws("\t", "seqname", F.col("n").cast("string")).alias("value")), output)


@command("vcf2fasta")
def vcf2fasta(spark, ref: str, genome: str, sample: str, output: str, mask: bool = False, gvcf_type: str = "gatk") -> None:
    """Two haplotype FASTA files of one sample's VCF, uncalled bases n if ``mask``."""
    records = readers.read_vcf(spark, genome).withColumn("sample_id", F.lit(sample))
    contigs = workflows.haplotypes_from_gvcf(readers.read_fasta(spark, ref), records, gvcf_type, mask)
    writers.write_lines(writers.fasta_lines(contigs).select("phase", "value"), output, by="phase", gzip=True)


@command("import")
def import_(spark, inputs: str, tag_library: str, ref: str, output: str, match_chromosome: str = r"^(chr)?([0-9]+|X|Y|MT?)$", skip_ooo: bool = False, mask: bool = False, gvcf_type: str = "gatk") -> None:
    """A library of the inputs, patterns joined by commas: haplotype FASTA files, VCF files of one sample each (whose
    variants are put into the reference, uncalled stretches n if ``mask``), or directories that hold such files."""
    paths = {"pair": [], "vcf": []}
    for path in inputs.split(","):
        if not re.search(r"\.[a-z0-9*?{}\[\]]+$", path):
            for row in readers.list_inputs(spark, path).where("kind in ('pair', 'vcf')").toLocalIterator():
                own = [row.path] if row.kind == "vcf" else [row.path, re.sub(r"\.1\.(fa|fasta)(\.gz)?$", r".2.\1\2", row.path)]
                paths[row.kind] += own
        else:
            paths["vcf" if re.search(r"\.vcf(\.gz)?$", path) else "pair"].append(path)
    parts = []
    if paths["pair"]:
        fasta = reduce(DataFrame.unionByName, [readers.read_fasta(spark, p) for p in paths["pair"]])
        parts.append(readers.haplotypes(readers.check_fasta(fasta)).where("phase is not null").select("sample", "phase", "seqname", "seq"))
    if paths["vcf"]:
        records = reduce(DataFrame.unionByName, [readers.read_vcfs(spark, p) for p in paths["vcf"]])
        parts.append(workflows.haplotypes_from_gvcf(readers.read_fasta(spark, ref), records, gvcf_type, mask).select("sample", "phase", "seqname", F.lower("seq").alias("seq")))
    if not parts:
        raise ValueError("there is nothing to import")
    twice = readers.check_tags(readers.read_tags(spark, tag_library)).first()
    if twice is not None:
        raise ValueError(f"tags {twice.tags} begin alike")
    contigs = reduce(DataFrame.unionByName, parts)
    lib = workflows.build_library(contigs, readers.read_fasta(spark, ref), readers.read_tags(spark, tag_library), chromosomes=match_chromosome, skip_out_of_order=skip_ooo)
    save(lib, output)


@command("merge")
def merge(spark, inputs: str, output: str) -> None:
    """One library of several with the same tags (paths joined by commas), which must be whole."""
    lib = _merged([load(spark, p) for p in inputs.split(",")])
    missing = library.missing_variants(lib.calls, lib.variants).select("tag", "hash").distinct().orderBy("tag", "hash").limit(100).collect()
    if missing:
        raise ValueError(f"calls without a variant (the first {len(missing)}): " + ", ".join(f"{r.tag} {r.hash}" for r in missing))
    save(lib, output)


@command("slice")
def slice_(spark, inputs: str, output: str, tags_per_file: int = 50_000) -> None:
    """The libraries (paths joined by commas; the same tags) as one, cut anew by ranges of tags.

    Variants are known by (tag, hash), so those of several libraries need no numbers of their own. The
    reference is the first library's.
    """
    save(_merged([load(spark, p) for p in inputs.split(",")]), output, int(tags_per_file))


@command("filter")
def filter_(spark, inputs: str, output: str, max_variants: int = -1, min_coverage: float = 0, max_tag: int = -1, match_genome: str = "") -> None:
    """Drop tags by the numbers of their variants, tags from ``max_tag`` on, tags of low coverage, and genomes.

    Other than the filter of ``export`` and ``flake``: a tag goes if any call's variant number is over ``max_variants``, and
    coverage is int(2 * fraction * genomes) calls, counted last.
    """
    lib = load(spark, inputs)
    genomes = lib.calls.select("sample").distinct().count()
    calls = lib.calls
    if int(max_variants) >= 0:
        everything = library.rank_variants(library.allele_counts(calls.withColumn("known", F.lit(True)), lib.ref_tiles))
        calls = filters.max_variant_number(library.renumber(calls, everything), int(max_variants)).drop("variant")
    calls = filters.min_coverage(filters.max_tag(calls, int(max_tag)), float(min_coverage), genomes, "command")
    lib.calls = filters.match_genome(calls, match_genome)
    save(lib, output)


@command("flake")
def flake(spark, inputs: str, output: str, **options) -> None:
    """Filter, then drop variants that neither a call nor the reference uses."""
    lib = _filtered(load(spark, inputs), **options)
    kept = library.tidy(lib.calls, lib.ref_tiles).select("tag", "hash")
    lib.variants = lib.variants.join(kept, ["tag", "hash"], "left_semi")
    save(lib, output)


@command("stats")
def stats(spark, inputs: str, output: str, debug_unplaced: bool = False) -> None:
    """Totals, called bases of each genome, placements and sizes, as lines of JSON; with ``debug_unplaced`` also the tags
    that the reference doesn't have."""
    lib = load(spark, inputs)
    bases = lib.variants.select("tag", "hash", F.coalesce(F.length("seq"), F.lit(0)).alias("bases"))
    sizes = lib.variants.select(F.length("seq").alias("len"), F.col("seq").isNotNull().alias("known"))
    for name, df in (("totals", library.totals(lib.calls, lib.variants)), ("called_bases", library.called_bases(lib.calls, bases)), ("placements", library.placement_histogram(lib.ref_tiles)), ("sizes", library.size_histogram(sizes))):
        writers.write_lines(writers.to_json(df), f"{output}/{name}")
    if debug_unplaced:
        unplaced = lib.tags.join(lib.ref_tiles.select("tag"), "tag", "left_anti").select("tag", "tagseq").orderBy("tag")
        writers.write_lines(writers.to_json(unplaced), f"{output}/unplaced")


@command("dumpgob")
def describe(spark, inputs: str) -> DataFrame:
    """Rows of each part of a library."""
    lib = load(spark, inputs)
    return library.describe(tags=lib.tags, variants=lib.variants, calls=lib.calls, ref_tiles=lib.ref_tiles, ref_seqs=lib.ref_seqs)


@command("dump")
def dump(spark, inputs: str, output: str, tags: str = "", match_genome: str = "", regions: str = "", expand_regions: int = 0) -> None:
    """Ranked variants of some tags, or of the tiles in some regions, with their sequences."""
    lib = load(spark, inputs)
    lib.calls = filters.match_genome(lib.calls, match_genome)
    tiles = lib.ref_tiles
    if regions:
        spans = tiles.withColumn("_s", F.col("seqname")).withColumn("seqname", F.regexp_replace("seqname", "^chr", "")).withColumn("start", F.col("pos")).withColumn("end", F.col("pos") + F.col("len"))
        tiles = intervals.semi_join(spans, readers.read_regions(spark, regions, int(expand_regions))).withColumn("seqname", F.col("_s"))
    ranked = workflows.ranked_variants(lib).join(lib.variants.select("tag", "hash", "seq"), ["tag", "hash"])
    rows = library.dump_variants(ranked, tiles, [int(t) for t in tags.split(",")] if tags else None)
    writers.write_lines(writers.csv_lines(rows.orderBy("tag", "variant"), rows.columns), output)


@command("tiling-stats")
def tiling_stats(spark, inputs: str, output: str) -> None:
    """BED of the reference's tiles with their share of called bases."""
    lib = load(spark, inputs)
    placed = lib.ref_tiles.withColumn("bases", F.length(F.regexp_replace("seq", "[^acgt]", "")))
    writers.write_lines(reference.bed_line(reference.tiling_bed(placed, lib.k).orderBy("seqname", "start")), output)


@command("annotate")
def annotate_(spark, inputs: str, output: str, variant_hash: bool = False, max_tile_size: int = 50_000) -> None:
    """Changes of every ranked variant: tag, output column, variant (or prefix of its hash), notation."""
    lib = load(spark, inputs)
    ranked = workflows.ranked_variants(lib)
    notes = annotate.annotations(ranked, workflows.compared_variants(lib, int(max_tile_size)), lib.ref_tiles, matrix.output_columns(lib.ref_tiles))
    rows = annotate.hashed_annotations(notes, ranked) if variant_hash else notes.where(~F.col("hgvs").isin("", "=")).select("tag", "outcol", "variant", "hgvs")
    writers.write_lines(writers.csv_lines(rows, rows.columns), output)


@command("export")
def export_(spark, inputs: str, output: str, output_format: str = "hgvs", output_bed: str = "", output_labels: str = "", z: bool = False, cases: str = "", p_value: float = 1, **options) -> None:
    """Variants by position in a registered format, a directory for each chromosome.

    With ``p_value`` under 1 the matrix of hgvs-numpy keeps the variants whose p, of hom or het carriers among
    ``cases`` (a file of name patterns) and all others, is that or less.
    """
    if float(p_value) < 1 and not (cases and output_format == "hgvs-numpy"):
        raise ValueError("a p-value needs cases, and the format hgvs-numpy")
    lib = _filtered(load(spark, inputs), **options)
    out = workflows.export_variants(lib, output_format)
    if float(p_value) < 1:
        flags = people.case_flags(lib.calls.select(F.col("sample").alias("name")).distinct(), readers.read_patterns(spark, cases))
        group = flags.select(F.col("name").alias("sample"), "is_case", F.lit(True).alias("is_training"))
        kept = association.hgvs_filter(out, group, float(p_value), 0).select("hgvs")
        out = out.join(kept, "hgvs", "left_semi")
    if "seqname" in out.columns:
        out.repartition("seqname").sortWithinPartitions("seqname", "position").write.option("compression", "gzip" if z else "none").partitionBy("seqname").csv(output, sep="\t")
    else:
        out.write.csv(output, sep="\t")
    names = lib.calls.select("sample").distinct()
    if output_bed:
        writers.write_lines(reference.bed_line(reference.coverage_bed(lib.ref_tiles, lib.calls, names.count(), lib.k)), output_bed)
    if output_labels:
        rows = people.numbered(names.withColumnRenamed("sample", "name")).select("idx", F.col("name").alias("label"), F.lit("").alias("file"))
        writers.write_lines(writers.labels(rows.orderBy("idx")), output_labels)


@command("export-numpy")
def export_numpy(spark, inputs: str, output: str, regions: str = "", expand_regions: int = 0, one_hot: bool = False, output_annotations: str = "", output_labels: str = "", hgvs: bool = False, npy: bool = True, tags_per_file: int = 50_000, **options) -> None:
    """Tile matrix in long form (or its one-hot columns), and annotations; with ``npy`` matrix.NNNN.npy for ranges of
    tags too (or onehot.npy, rows and columns of its ones), and with ``hgvs`` hgvs.npy, 0 and 1 by variant and phase."""
    lib = _filtered(load(spark, inputs), **options)
    names = people.numbered(lib.calls.select(F.col("sample").alias("name")).distinct()).withColumnRenamed("name", "sample")
    cells, notes = workflows.tile_matrix(lib, readers.read_regions(spark, regions) if regions else None, int(expand_regions))
    if one_hot:
        columns = matrix.onehot_recode(cells)
        columns.write.parquet(f"{output}/columns")
        ones = matrix.onehot_cells(cells, columns)
        ones.write.parquet(f"{output}/cells")
        if npy:
            writers.write_coordinates(ones.join(names, "sample").select(F.col("idx").alias("row"), F.col("outcol").alias("col")), f"{output}/onehot.npy")
    else:
        cells.write.parquet(f"{output}/cells")
        if npy:
            _write_tiles(cells, lib, names, output, int(tags_per_file))
    if hgvs:
        ranked = workflows.ranked_variants(lib)
        found = matrix.hgvs_cells(notes, library.renumber(lib.calls, ranked), lib.ref_tiles.join(ranked, ["tag", "hash"]).select("tag", "variant"), "present")
        _write_phases(found, names, output)
    if output_annotations:
        notes.write.csv(output_annotations)
    if output_labels:
        rows = names.select("idx", F.col("sample").alias("label"), F.lit("").alias("file"))
        writers.write_lines(writers.labels(rows.orderBy("idx")), output_labels)


def _write_tiles(cells: DataFrame, lib: Library, names: DataFrame, output: str, tags_per_file: int) -> None:
    """matrix.NNNN.npy for each range of tags among the cells: int16, a row for each sample, two columns for each tag."""
    columns = matrix.output_columns(cells)
    writers.write_matrices(writers.tile_cells(cells, columns, names, tags_per_file), "chunk", names.count(), "int16", lambda chunk: f"{output}/matrix.{chunk:04d}.npy")


def _write_phases(found: DataFrame, names: DataFrame, output: str, absent: int = 0) -> None:
    """hgvs.npy of cells (hgvs, sample, phase, value): int16, a column for each id and phase; a phase without a cell is ``absent``."""
    pairs = found.groupBy("hgvs", "sample").agg(F.max(F.when(F.col("phase") == 0, F.col("value"))).alias("first"), F.max(F.when(F.col("phase") == 1, F.col("value"))).alias("second"))
    writers.write_hgvs(pairs.select("hgvs", "sample", F.coalesce("first", F.lit(absent)).alias("first"), F.coalesce("second", F.lit(absent)).alias("second")), names, output, "int16")


@command("slice-numpy")
def slice_numpy(spark, inputs: str, output: str, samples: str = "", regions: str = "", expand_regions: int = 0, min_coverage: float = 0, case_control_only: bool = False, pca_components: int = 0, max_pca_tiles: int = 0, chi2_p_value: float = 1, pvalue_min_frequency: float = 0.01, max_frequency: float = 1, include_variant_1: bool = False, single_onehot: bool = False, single_hgvs_matrix: bool = False, chunked_hgvs_matrix: bool = False, npy: bool = True, tags_per_file: int = 50_000) -> None:
    """Tile matrix, annotations, one-hot columns with their tests, HGVS matrices and components; as Parquet, and with ``npy``
    as .npy files of the usual names too."""
    if float(chi2_p_value) < 1 and not samples or case_control_only and not samples:
        raise ValueError("this needs a samples file")
    lib = load(spark, inputs)
    names = people.numbered(lib.calls.select(F.col("sample").alias("name")).distinct()).withColumnRenamed("name", "sample")
    if samples:
        table = readers.read_samples(spark, samples)
        if readers.check_samples(table).first() is not None:
            raise ValueError("the samples aren't numbered 0, 1, 2...")
        wrong = people.misplaced(names.withColumnRenamed("sample", "sample_id"), table).orderBy("idx").first()
        if wrong is not None:
            raise ValueError(f"sample {wrong.idx} is {wrong.here} in the library and {wrong.there} in the samples file")
        names = table.select("idx", F.col("sample_id").alias("sample"), (F.col("case_control") == 1).alias("is_case"), (F.col("training") == 1).alias("is_training"), "training", "pca")
        names = filters.case_control_only(names) if case_control_only else names
        lib.calls = lib.calls.join(names.select("sample"), "sample", "left_semi")
    n = names.count()
    cells, notes = workflows.tile_matrix(lib, readers.read_regions(spark, regions) if regions else None, int(expand_regions), float(min_coverage), n)
    cells.write.parquet(f"{output}/matrix")
    notes.write.csv(f"{output}/annotations")
    library.slice_offsets(lib.ref_tiles, int(tags_per_file)).write.csv(f"{output}/chunk-tag-offset")
    rows = names.select("sample", (F.row_number().over(Window.orderBy("idx")) - 1).cast("long").alias("idx"))  # a row for each genome
    if npy:
        _write_tiles(cells, lib, rows, output, int(tags_per_file))
    numbered = library.renumber(lib.calls, workflows.ranked_variants(lib))
    carriers = matrix.genotypes(numbered)
    if single_onehot:
        columns = matrix.numbered_columns(matrix.homhet_columns(carriers, include_variant_1))
        if samples:
            low, high = float(pvalue_min_frequency), float(max_frequency)
            if names.where(F.size("pca") > 0).isEmpty():
                scan = association.with_pvalue(association.chi2_scan(carriers, names, low, high, include_variant_1), float(chi2_p_value))
            else:
                scan = association.glm_scan(carriers, names, low, high).join(association.frequencies(carriers, n), ["tag", "variant"])
                scan = scan if float(chi2_p_value) >= 1 else scan.where((F.col("pvalue") < float(chi2_p_value)) & ~F.isnan("pvalue"))
            columns = matrix.numbered_columns(columns.drop("col").join(scan.select("tag", "variant", "hom", "pvalue", "maf"), ["tag", "variant", "hom"]))
            association.descriptors(columns).write.parquet(f"{output}/onehot-columns")
            tested = library.describe(columns=columns).select(F.col("n").alias("pvalueCallCount"))
            writers.write_lines(writers.to_json(tested), f"{output}/stats")
            if npy:
                ordered = association.descriptors(columns.orderBy("col"))
                writers.write_npy(spark, f"{output}/onehot-columns.npy", writers.array_of(ordered, ordered.columns, "int32"))
        ones = matrix.coordinates(carriers, columns, rows)
        ones.write.parquet(f"{output}/onehot")
        if npy:
            writers.write_coordinates(ones, f"{output}/onehot.npy")
    for wanted, mode in ((single_hgvs_matrix, "single"), (chunked_hgvs_matrix, "chunked")):
        if wanted:
            ranks = lib.ref_tiles.join(workflows.ranked_variants(lib), ["tag", "hash"]).select("tag", "variant")
            found = matrix.hgvs_cells(notes, numbered, ranks, mode)
            found = matrix.hgvs_homhet(found) if mode == "chunked" else found
            found.write.parquet(f"{output}/hgvs-{mode}")
            if npy and mode == "chunked":
                writers.write_hgvs(found.select("hgvs", "sample", F.col("hom").alias("first"), F.col("het").alias("second")), rows, output, "int8", "seqname")
            elif npy:
                _write_phases(found, rows, output, -1)
    if int(pca_components):
        columns = matrix.stride_sample(matrix.numbered_columns(matrix.homhet_columns(carriers, include_variant_1)), int(max_pca_tiles))
        own = names if "is_training" in names.columns else names.withColumn("is_training", F.lit(True))
        own = own.drop("pca", "idx").join(rows, "sample")
        scores = pca.pca(matrix.coordinates(carriers, columns, rows), own, int(pca_components))
        scores.write.parquet(f"{output}/pca")
        if npy:
            writers.write_npy(spark, f"{output}/pca.npy", writers.matrix_of(scores, "idx", "pca", "float64"))


@command("numpy-comvar")
def common(spark, inputs: str, output: str, annotations: str = "", max_results: int = 256, min_frequency: float = 0.4, max_frequency: float = 0.6) -> None:
    """Variants within a band of frequency, with their annotations."""
    lib = load(spark, inputs)
    numbered = library.renumber(lib.calls.where("known"), workflows.ranked_variants(lib))
    rows = library.common_variants(numbered, float(min_frequency), float(max_frequency), lib.calls.select("sample").distinct().count(), limit=int(max_results))
    if annotations:
        rows = library.with_annotations(rows, readers.read_annotations(spark, annotations))
    rows.write.csv(output)


@command("choose-samples")
def choose_samples(spark, inputs: str, output: str, case_control_file: str = "", case_control_column: str = "", training_set_size: float = 0.8, random_seed: int = 0, match_genome: str = "") -> None:
    """samples.csv with case/control status and a training set."""
    names = filters.match_genome(load(spark, inputs).calls, match_genome).select(F.col("sample").alias("name")).distinct()
    patterns = readers.read_case_control(spark, case_control_file, case_control_column) if case_control_file else None
    split = people.training_split(people.case_control(names, patterns), float(training_set_size), int(random_seed))
    lines = writers.sample_lines(people.numbered(split).withColumnRenamed("name", "sample_id").withColumn("pca", F.array().cast("array<double>")))
    head = spark.createDataFrame([(-1, "Index,SampleID,CaseControl,TrainingValidation")], "idx int, value string")
    writers.write_lines(head.unionByName(lines).orderBy("idx").coalesce(1).select("value"), output)


@command("anno2vcf")
def anno2vcf(spark, inputs: str, output: str) -> None:
    """VCF records of an annotations CSV, a directory for each chromosome."""
    records = annotate.annotation_records(readers.read_annotations(spark, inputs)).withColumnRenamed("pos", "position")
    from tesserae.operators.export import vcf_lines

    lines = vcf_lines(records, identity="id").repartition("seqname").sortWithinPartitions("seqname", "position").select("seqname", "value")
    writers.write_lines(lines, output, by="seqname")


@command("diff-fasta")
def diff_fasta(spark, a: str, b: str, offset: int = 0, sequence: str = "chr1") -> DataFrame:
    """Changes between the sequences of two FASTA files, each read whole, its contigs in the order of the file."""

    def whole(path, name):
        bases = F.regexp_replace(F.regexp_replace("value", "(?m)^>.*$", ""), r"\s", "")
        files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.upper(bases).alias("seq"))
        parts = F.array_sort(F.collect_list(F.struct("file", "seq")))
        return files.agg(F.array_join(F.transform(parts, lambda p: p["seq"]), "").alias(name)).withColumn("one", F.lit(1))

    rows = whole(a, "a").join(whole(b, "b"), "one").select(F.explode(variants_udf("a", "b")).alias("c"))
    at = F.col("c.position").cast("long") + int(offset)
    return rows.select(genomic(F.lit(sequence), at, F.col("c.ref"), F.col("c.new")).alias("hgvs"), F.lit(sequence).alias("seqname"), at.alias("position"), F.col("c.ref").alias("ref"), F.col("c.new").alias("new"))


def plot(spark, inputs: str, samples: str = "", phenotype: str = "", x: int = 1, y: int = 2) -> DataFrame:
    """Points of a scatter of two components, with the phenotype of each sample."""
    rows = spark.read.parquet(inputs)
    if phenotype:
        table = spark.read.csv(phenotype, header=True, sep="\t")
        first, value = table.columns[:2]
        lines = table.select(F.col(f"`{first}`").alias("pattern"), F.col(f"`{value}`").alias("value"), F.monotonically_increasing_id().alias("line"))
        found = people.phenotype(rows.select(F.col("sample").alias("name")), lines).withColumnRenamed("name", "sample")
        rows = rows.join(found, "sample")
    return pca.plot_points(rows, int(x), int(y), "value" if phenotype else None)


COMMANDS["plot"] = COMMANDS["pca-plot"] = plot


@command("manhattan-plot")
def manhattan(spark, inputs: str, library_path: str, csv_output: str = "", csv_output_threshold: float = 0) -> DataFrame:
    """Points of a Manhattan plot of tested columns; those with -log10 p of ``csv_output_threshold`` or more as CSV too."""
    columns, tiles = spark.read.parquet(inputs), load(spark, library_path).ref_tiles
    if "p" in columns.columns:  # descriptors, in millionths
        columns = columns.withColumn("pvalue", F.col("p") / 1_000_000)
    if csv_output:
        association.manhattan_points(columns, tiles, float(csv_output_threshold)).write.csv(csv_output, header=True)
    return association.manhattan_points(columns, tiles)


@command("gvcf-regions")
def gvcf_regions(spark, gvcf: str, output: str, gvcf_type: str = "gatk") -> None:
    """BED of the called regions of a gVCF."""
    blocks = vcf.gvcf_blocks(readers.read_vcf(spark, gvcf), gvcf_type)
    rows = intervals.called_regions(blocks, vcf.PRESETS[gvcf_type]["unreported_called"])
    writers.write_lines(rows.orderBy("seqname", "start").select(F.concat_ws("\t", "seqname", F.col("start").cast("string"), F.col("end").cast("string")).alias("value")), output)
