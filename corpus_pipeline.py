"""A pipeline over ``documents``: each stage is one of the operators in ``waybill.llm``.

Every stage takes what the one before kept. Texts, ids and the other columns pass
through as they are, unless a stage says otherwise; null and empty texts pass all
filters. Extra columns pass through, empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontaminate, ngram_join, repeats, sentencepiece_codec, toxicity
from waybill.llm.catalog import TOKENIZERS
from waybill.llm.common import staged, table

#: Bytes of a passage that counts as repeated: below any passage of 50 words, above common lines.
PASSAGE_BYTES = 150


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, by the labels of ``labels``."""
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, index, score_column="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).drop("_toxicity")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a Jaccard similarity of 0.8 or more of its sets of five words."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that also start in a document of smaller id; ``n_chars`` follows the text.

    Documents that consist of such passages only go.
    """
    cut = repeats.without_repeats(docs.withColumn("_length", F.length("text")), PASSAGE_BYTES)
    n_chars = F.when(F.length("text").eqNullSafe(F.col("_length")), F.col("n_chars")).otherwise(F.length("text"))
    return cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).drop("_length")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of ``benchmark`` or a longer excerpt of one."""
    return decontaminate.drop_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``piece_ids``, ``n_pieces`` and ``decoded``, the text that the pieces give back."""
    model = sentencepiece_codec.UnigramModel.load(f"{TOKENIZERS}/piece_bpe_32k.model")
    encoded = sentencepiece_codec.with_pieces(docs, model)
    return encoded.withColumn("n_pieces", F.size("piece_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: The stages score, search and tokenise in ways SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
