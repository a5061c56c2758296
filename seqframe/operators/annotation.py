"""Gene annotation: feature tables, codons, proteins, conflicts, models against transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators.pileup import SEGMENT, joined_segments, segments

# Typed attributes of each feature type's table.
FEATURE_ATTRIBUTES = {"gene": ["ID", "Name", "Dbxref", "locus_tag"], "mRNA": ["ID", "Parent", "Name", "product"], "exon": ["ID", "Parent"], "CDS": ["ID", "Parent", "protein_id", "product"], "start_codon": ["Parent"], "stop_codon": ["Parent"]}


def feature_table(features: DataFrame, kind: str, attributes: list[str] | None = None) -> DataFrame:
    """Rows of one feature type with typed attributes; the rest as text ``k=v; k=v``; a generated id where none is given."""
    names = attributes if attributes is not None else FEATURE_ATTRIBUTES.get(kind, ["ID", "Parent"])
    attrs = F.col("attrs")
    rest = S.attributes_to_string(F.map_filter(attrs, lambda k, v: ~k.isin(names)))
    own = [F.try_element_at(attrs, F.lit(a)).alias(a) for a in names]
    out = features.filter(F.col("type") == kind).select("seqid", "source", "start_pos", "end_pos", "strand", "phase", *own, rest.alias("other"))
    if "ID" in names:
        made = F.concat_ws(":", F.lit(kind), "seqid", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), "strand")
        out = out.withColumn("ID", F.coalesce("ID", made))
    return out


def feature_tables(features: DataFrame) -> dict[str, DataFrame]:
    return {kind: feature_table(features, kind) for kind in FEATURE_ATTRIBUTES}


def transcripts_of(exons: DataFrame) -> DataFrame:
    """One row for each transcript from its exons: place, length, number of exons."""
    return exons.groupBy("genomicid", "strand", "transcript_id", "gene_id").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("length"), F.count("*").alias("n_exons"))


def missing_codons(proteins: DataFrame, codons: DataFrame, on: str = "protein_id") -> DataFrame:
    return proteins.join(codons.select(on), on, "left_anti")


def codon_presence(cds: DataFrame, starts: DataFrame, stops: DataFrame, on: str = "protein_id") -> DataFrame:
    flag = lambda df, n: df.select(on).distinct().withColumn(n, F.lit(True))
    out = cds.join(flag(starts, "__a"), on, "left").join(flag(stops, "__b"), on, "left")
    return out.withColumn("has_start", F.col("__a").isNotNull()).withColumn("has_stop", F.col("__b").isNotNull()).drop("__a", "__b")


def integrate(raw: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of both tables that meet."""
    return raw.join(other, on)


def integrate_protein(raw: DataFrame, sequences: DataFrame) -> DataFrame:
    """(gi, proteinid, geneid, product, attribute, sequence) of the proteins that have a sequence."""
    return raw.join(sequences.select("gi", "proteinid", "sequence"), "proteinid").select("gi", "proteinid", "geneid", "product", "attribute", "sequence")


def integrate_qc(comparisons: DataFrame, results: DataFrame) -> DataFrame:
    """(result_id, columns of the comparison) where a result of the same input and fraction is known."""
    rest = [c for c in comparisons.columns if c not in ("input", "fraction")]
    return comparisons.join(results.select("input", "fraction", F.col("id").alias("result_id")), ["input", "fraction"]).select("result_id", *rest)


def attribute_conflicts(genes: DataFrame, parts: DataFrame, columns: list[str], on: str = "gene_id") -> DataFrame:
    """Parts whose attributes differ from their gene's."""
    g = genes.select(on, *[F.col(c).alias(f"gene_{c}") for c in columns])
    differ = ~F.struct(*columns).eqNullSafe(F.struct(*[F.col(f"gene_{c}").alias(c) for c in columns]))
    return parts.join(g, on).filter(differ)


def multi_start_proteins(starts: DataFrame, on: str = "protein_id") -> DataFrame:
    """All start codons of proteins with more than one."""
    return starts.withColumn("__n", F.count("*").over(Window.partitionBy(on))).filter("__n > 1").drop("__n")


def model_vs_transcript(models: DataFrame, transcripts: DataFrame, on: str = "transcript_id", limit: int = 40) -> DataFrame:
    """class of a model: small if its exon sum is within limit of the transcript's length, also without its trailing poly-A; else long or short."""
    j = models.join(transcripts.select(on, "seq"), on)
    n = F.length("seq")
    bare = n - S.poly_tail_length("seq")
    diff = F.col("length") - n
    kind = F.when(F.abs(diff) < limit, "small").when(F.abs(F.col("length") - bare) < limit, "small_without_tail").when(diff > 0, "long").otherwise("short")
    return j.select(on, "length", n.alias("transcript_length"), kind.alias("class"))


def project_request(projects: DataFrame, sites: DataFrame, references: DataFrame, on: str = "project") -> DataFrame:
    """One row a project: lengths of its cut sites and its reference."""
    return projects.join(sites, on).join(references, on).select(on, F.length("head").alias("head_length"), F.length("tail").alias("tail_length"), F.length("seq").alias("reference_length"), "seq")


def check_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are null or there more than once: empty for a table that may be loaded."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)).cast("boolean"))


def call_consensus(vcf: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(chrom, consensus): the first ALT where the first allele count is 2, else REF, joined in order of position."""
    return joined_segments(call_consensus_segments(vcf), "chrom")


def call_consensus_segments(vcf: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(chrom, segment, text) of ``call_consensus``, by ranges of positions."""
    base = F.when(F.element_at(F.split("ac", ","), 1).cast("int") == 2, F.element_at(F.split("alt", ","), 1)).otherwise(F.col("ref"))
    return segments(vcf.select("chrom", "pos", base.alias("b")), "chrom", size)


def load_annotation(features: DataFrame, key: str = "transcript_id", gene: str = "gene_id") -> dict[str, DataFrame]:
    """Tables of one annotation file (rows of read_gff3 or read_gtf): exons in order, transcripts, integrated genes, conflicts, and keys that forbid a load.

    exons have a serial number along the strand; transcripts are joined with the place of their gene; conflicts are
    transcript ids with more than one gene; bad_keys is empty where transcripts may be loaded.
    """
    from seqframe.operators.intervals import order_exons

    attr = lambda *names: F.coalesce(*[F.try_element_at("attrs", F.lit(n)) for n in names])
    exons = features.filter("type = 'exon'").select(F.col("seqid").alias("genomicid"), "strand", attr(key, "Parent").alias("transcript_id"), attr(gene, "gene").alias("gene_id"), "start_pos", "end_pos")
    transcripts = transcripts_of(exons)
    genes = transcripts.groupBy("gene_id").agg(F.min("start_pos").alias("gene_start"), F.max("end_pos").alias("gene_end"), F.count("*").alias("n_transcripts"))
    conflicts = exons.groupBy("transcript_id").agg(F.count_distinct("gene_id").alias("n_genes")).filter("n_genes > 1")
    return {"exons": order_exons(exons), "transcripts": integrate(transcripts, genes, ["gene_id"]), "conflicts": conflicts, "bad_keys": check_keys(transcripts, ["transcript_id"])}


# Feature types of transcripts, and of whole sequences.
TRANSCRIPT_TYPES, SOURCE_TYPES = ("mRNA", "transcript", "ncRNA", "tRNA", "rRNA"), ("region", "source")


def typed_annotation(features: DataFrame) -> dict[str, DataFrame]:
    """The rows of the typed tables (``sources.typed_tables``) that are in one annotation file (rows of read_gff3): source, gene, transcript, exon, protein, cds, start_codon and stop_codon.

    Exons and coding parts are numbered along the strand. A protein is named by protein_id, else by its transcript; its gene is that of
    its transcript, else the ``gene`` attribute. Attributes without a column are joined to one text.
    """
    attr = lambda *names: F.coalesce(*[F.try_element_at("attrs", F.lit(n)) for n in names])
    rest = lambda *names: S.attributes_to_string(F.map_filter("attrs", lambda k, v: ~k.isin(*names)))
    place = [F.col("seqid").alias("genomicid"), "strand", "start_pos", "end_pos"]
    of = lambda *kinds: features.filter(F.col("type").isin(*kinds))
    along = F.when(F.col("strand") == "-", -F.col("end_pos")).otherwise(F.col("start_pos"))
    number = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(along, "end_pos"))
    transcripts = of(*TRANSCRIPT_TYPES).select(attr("ID", "transcript_id").alias("transcriptid"), F.col("type").alias("rna_type"), attr("Parent", "gene_id").alias("geneid"), rest("ID", "Parent").alias("attribute"))
    protein = attr("protein_id", "Parent").alias("proteinid")
    cds = of("CDS").select(*place, F.col("phase").try_cast("int").alias("phase"), attr("ID").alias("id"), protein, attr("Parent").alias("parent"), attr("gene", "gene_id").alias("named"), attr("product").alias("product"))
    proteins = cds.groupBy("proteinid").agg(F.min("parent").alias("parent"), F.min("named").alias("named"), F.min("product").alias("product"))
    owned = proteins.join(transcripts.select(F.col("transcriptid").alias("parent"), "geneid"), "parent", "left")
    codons = lambda kind: of(kind).select(*place, protein)
    return {
        "source": of(*SOURCE_TYPES).select(*place, attr("mol_type").alias("mol_type"), attr("chromosome").alias("chromosome"), attr("organism").alias("organism")),
        "gene": of("gene").select(*place, attr("ID", "gene_id").alias("id"), rest("ID").alias("attribute")),
        "transcript": transcripts,
        "exon": of("exon").select(*place, attr("Parent", "transcript_id").alias("transcriptid")).withColumn("exon_number", number("transcriptid")),
        "protein": owned.select("proteinid", F.coalesce("geneid", "named").alias("geneid"), "product", F.lit(None).cast("string").alias("attribute")),
        "cds": cds.withColumn("exon_number", number("proteinid")).drop("parent", "named", "product"),
        "start_codon": codons("start_codon"), "stop_codon": codons("stop_codon"),
    }
