"""Tables of the data model, as Spark DDL.

A tile variant's identity is (tag, hash); variant numbers are ranks, computed late. Calls are long: a row
for each sample, tag and phase; a tag that wasn't found has no row. ``known`` is false where the bases
contain no-calls, so that only the hash is known.
"""

TAGS = "tag int, tagseq string"
CONTIGS = "file string, sample string, phase int, seqname string, seq string"
TILES = "sample string, phase int, seqname string, step int, tag int, start int, hash string, seq string"
TILE_VARIANTS = "tag int, hash string, is_ref boolean, seq string"
CALLS = "sample string, tag int, phase int, hash string, known boolean"
REF_TILES = "tag int, seqname string, pos long, len long, hash string, seq string, next_tag int"
REGIONS = "seqname string, start long, end long"
SAMPLES = "idx int, sample_id string, case_control int, training int, pca array<double>"
GVCF = "chrom string, pos long, id string, ref string, alt string, qual double, filter string, info string, format string, sample string"
ANNOTATIONS = "tag int, outcol int, variant int, hgvs string, seqname string, position long, ref string, new string, left string"
ONEHOT_COLUMNS = "col long, tag int, variant int, hom boolean, pvalue double, maf double"
EMPTY_TAG = 0
LOW_QUALITY = -1
