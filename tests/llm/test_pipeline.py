"""The pipeline's stages, each against a plain implementation over its own input, and its queries' registration."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayer.llm.crf import Labeller, words_of
from assayer.llm.language import train
from assayer.llm.mixing import mix
from assayer.llm.secrets import find_secrets

SF = "/root/testdata/sf0.001"


def _brute_language(docs, rows):
    """By the same model, one text at a time on the driver."""
    labeller, stay = Labeller(train(docs)), []
    for row in rows:
        words = words_of(row.text or "")
        if words and labeller.shares([words])[0].max() >= corpus_pipeline.LEAST_SHARE:
            stay.append(row)
    return Counter(stay)


def _brute_classes(rows):
    """All pairs by their sets of five words; the row with the least id of each class."""
    grams = []
    for row in rows:
        words = (row.text or "").encode().split()
        width = min(5, len(words))
        grams.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if grams[a] and grams[b] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                root[find(a)] = find(b)
    best = {}
    for i, row in enumerate(rows):
        at = find(i)
        rank = (row.doc_id is None, row.doc_id or 0)
        if at not in best or rank < best[at][0]:
            best[at] = (rank, row.doc_id)
    return Counter(doc_id for _, doc_id in best.values())


def _redacted(text):
    out, at = "", 0
    for _, start, end in find_secrets(text or ""):
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return None if text is None else out + text[at:]


def _hold_the_contract(spark, docs):
    columns, seen, rows = docs.columns, {}, {"documents": docs.collect()}
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        seen[name], rows[name], kept[name] = docs, docs.collect(), docs
        if name != "packing":
            assert docs.columns == columns
    assert Counter(rows["language_id"]) == _brute_language(kept["documents"], rows["documents"])
    assert Counter(r.doc_id for r in rows["ngram_join"]) == _brute_classes(rows["language_id"])
    before = Counter(rows["language_id"])
    assert all(before[row] for row in rows["ngram_join"])
    clean = {(r.doc_id, _redacted(r.text)) for r in rows["ngram_join"]}
    assert {(r.doc_id, r.text) for r in rows["secret_scans"]} == clean
    assert all(r.n_chars == len(r.text) for r in rows["secret_scans"])
    # What the mix takes of a document is its words, times the copies.
    taken = {r.doc_id: r.taken // r.size for r in mix(seen["secret_scans"]).collect() if r.size}
    assert Counter(r.doc_id for r in rows["source_mixing"]) == Counter({i: n for i, n in taken.items() if n})
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 2] for r in rows["source_mixing"]}
    places = Counter()
    for p in rows["packing"]:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
        places.update((p.doc_id, p.start + k) for k in range(p.length))
    assert places == Counter({(i, k): taken[i] for i in ids for k in range(len(ids[i]))})
    return seen, rows


def test_stages_against_plain_implementations(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, rows = _hold_the_contract(spark, docs)
    assert len(rows["language_id"]) >= 0.95 * len(rows["documents"]) and len(rows["ngram_join"]) < len(rows["language_id"])


def test_stages_of_repeated_null_and_empty_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(90_000, None, "en", "a", None), (90_001, "", None, None, 0), (90_002, "12 !", "en", "a", 4)], docs.schema)
    telling = docs.limit(2).withColumns({"doc_id": F.col("doc_id") + 91_000, "text": F.concat(F.array_join(F.reverse(F.split("text", " ")), " "), F.lit(" more words AKIA"), F.lit("Q" * 16), F.lit(" password=longenough"))})
    _, rows = _hold_the_contract(spark, docs.unionByName(odd).unionByName(docs.limit(5)).unionByName(telling).coalesce(2))
    texts = [r.text for r in rows["secret_scans"]]
    assert any("words [secret] [secret]" in t for t in texts) and not any(re.search("AKIA[A-Z0-9]{16}", t) for t in texts)


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        assert docs.count() == 0


@pytest.mark.parametrize("n", range(1, 14))
def test_one_query_for_each_operator(n):
    assert len([q for q in entry.queries() if q.startswith(f"op{n}_")]) == 1


def test_pipeline_is_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
