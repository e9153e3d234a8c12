"""Language identification by a conditional random field over words, fitted on a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import reachable, small_batches
from assayer.llm.crf import Labeller, Model, fit, words_of

UNKNOWN = "und"
#: Texts of each language in the sample at most, and the longest it takes, in bytes. These bound what the driver holds.
PER_LANGUAGE, LONGEST = 250, 12_000
#: Characters whose words a task holds at a time (one text more at most).
CHUNK = 2_000_000


def fold(key: str = "doc_id") -> Column:
    """0 to 3, from the key as text. Fold 2 is held out."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model from texts outside fold 2 with a language; None if there are none.

    The sample has ``per_language`` different texts of each language, the first by a hash, of up to ``LONGEST`` bytes. A
    language all of whose texts are longer is learned from as much of their beginnings. Copies count once, and no more
    than the sample reaches the driver.
    """
    usable = docs.filter(F.coalesce(fold(key), F.lit(0)) != 2).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    usable = usable.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    # Short texts before long ones; ranks are cut to the quota in each task before rows are shuffled.
    first = Window.partitionBy("lang").orderBy("long", "hash")
    ranked = usable.select("lang", "hash", (F.octet_length("text") > LONGEST).alias("long")).distinct().withColumn("rank", F.row_number().over(first))
    chosen = ranked.filter(F.col("rank") <= per_language)
    short = Window.partitionBy("_lang")
    chosen = chosen.select(F.col("lang").alias("_lang"), F.col("hash").alias("_hash"), "long").withColumn("_any_short", F.bool_or(~F.col("long")).over(short))
    chosen = chosen.filter(~F.col("long") | ~F.col("_any_short")).select("_lang", "_hash")
    same = (F.col("lang") == F.col("_lang")) & (F.col("hash") == F.col("_hash"))
    # Smaller than the sample, which the driver holds anyway; no text is shuffled but the chosen ones.
    sample = usable.join(F.broadcast(chosen), same).groupBy("lang", "hash").agg(F.first(F.substring("text", 1, LONGEST)).alias("text")).collect()
    if not sample:
        return None
    rows = sorted(sample, key=lambda r: (r["lang"], r["text"]))
    return fit([words_of(row["text"]) for row in rows], [row["lang"] for row in rows])


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the language with the largest share of the letters, and that share.

    Both come from the probabilities of each word's language, summed over the whole text. A null text or one without a
    letter is ``und`` with score 0, and so is everything without a model. Ties go to the first language by name.
    Columns of these two names are replaced. Only the text goes to Python.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    reachable(docs.sparkSession)
    small_batches(docs.sparkSession)
    labeller: list[Labeller] = []

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(texts: pa.Array) -> pa.Array:
        if not labeller:
            labeller.append(Labeller(shared.value))
        shares, held, size = [np.zeros((0, len(shared.value.labels)))], [], 0
        for cell in texts:
            held.append(words_of(cell.as_py() or ""))
            size += len(held[-1]) * 6
            if size >= CHUNK:
                shares.append(labeller[0].shares(held))
                held, size = [], 0
        if held:
            shares.append(labeller[0].shares(held))
        share = np.concatenate(shares)
        best = share.argmax(axis=1)
        score = np.clip(share[np.arange(len(share)), best].astype(float), 0.0, 1.0)
        names = [shared.value.labels[b] if s > 0 else UNKNOWN for b, s in zip(best.tolist(), score.tolist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], names=["lang_pred", "score"])

    told = docs.withColumn("_told", predicted(F.col(f"`{text}`").cast("string")))
    return told.withColumns({"lang_pred": F.col("_told.lang_pred"), "score": F.col("_told.score")}).drop("_told")


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``, by a model fitted on the same table.

    The model learns from texts and languages outside fold 2; a prediction reads the text alone. Null keys belong to no
    fold: they are not held out. Null languages are not learned. Repeated rows get equal predictions. Columns other
    than the three named are ignored. An empty table gives an empty result.
    """
    model = train(docs, key=key, text=text, lang=lang)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(fold(key) == 2, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("_text"))
    return identify(rows, model, "_text").select("doc_id", "held_out", "lang_pred", "score")
