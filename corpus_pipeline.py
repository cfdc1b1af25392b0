"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

1. quality rules: rejected documents go, failing lines of the others too;
2. near-duplicates: one document of each BagMinHash class stays;
3. decontamination: benchmark passages are cut out of the texts;
4. secrets: every span found is replaced by a mark;
5. packing: every remaining document gets its length bucket, batch and slot
   (one row per document; its text is that of stage 4, by ``doc_id``).

No SQL for the whole (stages 2 to 5 are no SQL); tests hold each stage against
a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import bagminhash, decontam, packing, quality, secrets
from flowlens.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("secret scan", secret_scan), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
