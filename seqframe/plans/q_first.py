"""The minimum slice: reads, filtered, unique, counted."""

from pyspark.sql import functions as F

from seqframe.operators.dedupe import unique_by_id
from seqframe.operators.select import filter_length
from seqframe.plans import fixtures
from seqframe.plans.registry import query


@query("minimum_slice", "src:s n_reads:n n_bases:n longest:n", "select src, count(*) as n_reads, sum(length(seq)) as n_bases, max(length(seq)) as longest from fx_reads where length(seq) > 30 group by src", ("fx_reads",))
def minimum_slice(spark, sf_dir):
    reads = unique_by_id(filter_length(fixtures.reads(spark, sf_dir), 30), "read_id")
    n = F.length("seq")
    return reads.groupBy("src").agg(F.count("*").alias("n_reads"), F.sum(n).alias("n_bases"), F.max(n).alias("longest"))
