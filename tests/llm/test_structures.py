"""Prefix trie, passage removal and Merkle manifest, each against a plain implementation."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from assayer.llm import substring_dedup
from assayer.llm.merkle import backward, fold, forward, manifest, proof
from assayer.llm.prefix_trie import prefix_trie
from assayer.llm.spill import SpillingQueue
from assayer.llm.substring_dedup import WIDTH, Words, normal, passage_digest, without_repeats
from .conftest import CLASHES, SCHEMA


def _sha(*parts) -> str:
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def _crc(number) -> int:
    return zlib.crc32(str(number).encode())


# ---- the queue ----


@pytest.mark.parametrize("held", [1, 3, 7, 1000])
def test_a_spilling_queue_gives_labels_in_order_and_their_entries_in_turn(held):
    rng = random.Random(held)
    queue, put = SpillingQueue(held), defaultdict(list)
    for n in range(500):
        label = (rng.randrange(40), rng.choice("ab"))
        queue.push(label, n)
        put[label].append(n)
    for label in sorted(put):
        assert queue.next_label() == label
        assert queue.take(label) == put[label]
    assert queue.next_label() is None and queue.take((9, "z")) == []
    assert (queue.runs > 0) == (held < 500)


def test_an_entry_that_was_passed_over_is_an_error():
    queue = SpillingQueue(2)
    for label in (5, 1, 3):
        queue.push(label, label)
    with pytest.raises(ValueError, match="never taken"):
        queue.take(2)


def test_entries_may_come_while_others_are_taken():
    queue, seen = SpillingQueue(2), []
    for n in range(10):
        queue.push(n, n)
    while (label := queue.next_label()) is not None:
        for payload in queue.take(label):
            seen.append(payload)
            if payload < 10:
                queue.push(label + 10, payload + 10)
    assert sorted(seen) == list(range(20)) and seen == sorted(seen)


# ---- Merkle ----


def _merkle(rows) -> set[tuple]:
    """By whole levels, in memory."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, more=0):
        doc_id, text, lang, source, n_chars = row
        return _sha(*map(field, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))

    def tree(digests):
        """The root and, for each digest, its steps."""
        paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
        while len(level) > 1:
            for path, place in zip(paths, at, strict=True):
                other = place ^ 1
                path.append((other < place, level[other] if other < len(level) else None))
            level = [_sha(*level[i : i + 2]) for i in range(0, len(level), 2)]
            at = [place // 2 for place in at]
        return level[0], paths

    def climb(digest, steps):
        for left, sibling in steps:
            digest = _sha(digest) if sibling is None else _sha(sibling, digest) if left else _sha(digest, sibling)
        return digest

    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    trees = {lang: tree([leaf(row) for row in by_lang[lang]]) for lang in langs}
    root, tops = tree([trees[lang][0] for lang in langs]) if langs else (None, [])
    found = []
    for lang, top in zip(langs, tops, strict=True):
        for row, path in zip(by_lang[lang], trees[lang][1], strict=True):
            steps = path + top
            hit = row[0] is not None and row[4] is not None and _crc(row[0]) % 7 == 0
            folded = climb(leaf(row, 1 if hit else 0), steps)
            found.append((row[0], leaf(row), trees[lang][0], root, _sha(*[s for _, s in steps if s]), folded, folded == root))
    return sorted(found, key=repr)


_MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _manifest(docs):
    return sorted((tuple(r) for r in manifest(docs).select(*_MANIFEST).collect()), key=repr)


def test_manifest_of_odd_documents(odd_docs, odd_rows):
    found = _manifest(odd_docs)
    assert found == _merkle(odd_rows)
    assert {verified for *_, verified in found} == {True, False}


def test_manifest_of_trees_of_several_blocks(spark):
    """One language over two blocks, so many languages that their tree takes two rounds, and languages of one row."""
    rows = [(i, f"text {i}", "big", "a", i) for i in range(2_100)] + [(5_000 + i, "x", f"l{i}", None, 1) for i in range(1_030)]
    assert _manifest(spark.createDataFrame(rows, SCHEMA).repartition(5)) == _merkle(rows)


@pytest.mark.parametrize("rows", [[(1, "a", None, None, 2)], [(7, "a", "en", "s", None)] * 3, [(1, "a", "en", "s", 2), (2, None, None, "s", 2)]])
def test_small_manifests(spark, rows):
    assert _manifest(spark.createDataFrame(rows, SCHEMA)) == _merkle(rows)


def test_manifest_of_nothing(no_docs):
    assert manifest(no_docs).collect() == []


def test_a_block_goes_up_and_down_again():
    leaves = [_sha(str(i)) for i in range(11)]
    root, nodes = forward(leaves, 32, 4)
    paths = list(backward(nodes, 32, 11, "N"))
    assert {fold(leaf, path) for leaf, path in zip(leaves, paths, strict=True)} == {_sha(root)}
    assert proof("N") == _sha("") and proof(f"L{leaves[0]}NR{leaves[1]}") == _sha(leaves[0], leaves[1])


# ---- trie ----

_TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _trie(rows) -> set[tuple]:
    """With all members of every node in memory. Turns that share a number must be equal here."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    built = {conv: own.get(conv - conv % 5 if conv >= 0 else conv + (-conv) % 5, [])[: _crc(conv) % 9] + turns[_crc(conv) % 9 :] for conv, turns in own.items()}
    members = defaultdict(list)
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def totals(node):
        below = [totals(child) for child in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        return sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below)

    found = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        found.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), *totals(node), _sha(ends)))
    return found


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def _conversations(seed: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    starts = ["hello", "same first turn", "", "ü and 中"]
    for conv in [*range(-12, 60), 1000, 1001, 2**40]:
        for turn in range(rng.choice([1, 2, 3, 6, 12])):
            rows.append((conv, turn, ("user", "assistant", None)[turn % 3], rng.choice(starts) if turn < 3 else rng.choice([None, "a", "b" * turn])))
    # Conversations with the same turns throughout, longer than any taken beginning.
    rows += [(conv, turn, "user", f"line {turn}") for conv in range(200, 240) for turn in range(15)]
    rows += [(70, None, "user", "no number"), (70, 3, "user", "later"), (71, 0, "user", "twice"), (71, 0, "user", "twice"), (None, 0, "user", "no id")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain_sets(spark, seed):
    rows = _conversations(seed)
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    clashing = frame.selectExpr("*", *[f"'{c}' AS {c}" for c in (*CLASHES, "depth", "node", "parent", "part", "at", "top")])
    found = prefix_trie(clashing)
    assert found.columns == list(_TRIE)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == _trie(rows)


def test_a_long_conversation_is_a_long_branch(spark):
    rows = [(1, turn, "user", f"turn {turn}") for turn in range(3_000)]
    got = {tuple(r) for r in prefix_trie(spark.createDataFrame(rows, CONVERSATIONS)).collect()}
    assert max(r[1] for r in got) in (3_000, 3_000 - _crc(1) % 9) and {r[5] for r in got} == {1}


def test_small_tries(spark):
    assert prefix_trie(spark.createDataFrame([], CONVERSATIONS)).collect() == []
    for rows in ([(0, 0, None, None)], [(3, 0, "user", "x")], [(None, 1, "user", "x")]):
        assert {tuple(r) for r in prefix_trie(spark.createDataFrame(rows, CONVERSATIONS)).collect()} == _trie(rows)


# ---- passages ----


def _without(rows) -> list[tuple]:
    """With every window of the table in one dictionary."""
    last = float("inf")
    texts = [(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc_id, text, *_ in rows]
    least: dict[tuple, float] = {}
    for doc_id, words in texts:
        for i in range(len(words) - WIDTH + 1):
            window = tuple(words[i : i + WIDTH])
            least[window] = min(least.get(window, last), last if doc_id is None else doc_id)
    found = []
    for doc_id, words in texts:
        gone = set()
        for i in range(len(words) - WIDTH + 1):
            if least[tuple(words[i : i + WIDTH])] < (last if doc_id is None else doc_id):
                gone.update(range(i, i + WIDTH))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((doc_id, len(words), len(gone), _sha(kept)))
    return sorted(found, key=repr)


def _digest(docs) -> list[tuple]:
    return sorted((tuple(r) for r in passage_digest(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def test_passages_of_odd_documents(odd_docs, odd_rows):
    assert _digest(odd_docs) == _without(odd_rows)


def test_passages_at_every_place(spark):
    """Passages of 11 to 60 words in many documents, some in most of them, so that windows and minimisers are hot."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 5)))
    shared = [[word() for _ in range(n)] for n in (11, 12, 13, 14, 30, 60)]
    rows = []
    for doc_id in range(400):
        words = [word() for _ in range(rng.randint(0, 60))]
        for passage in [p for p in shared if rng.random() < 0.4] + ([shared[-1]] if doc_id % 3 else []):
            at = rng.randint(0, len(words))
            words[at:at] = passage
        text = "".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in words)
        rows.append((doc_id if doc_id % 50 else None, text, "en", "a", 1))
    rows += rows[10:13] + [(rows[20][0], rows[21][1], "en", "a", 1), (9_000, "of of " * 40, "en", "a", 1), (9_001, "of " * 70, "en", "a", 1)]
    found = _digest(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert found == _without(rows)
    assert sum(r[2] for r in found) > 5_000


def test_a_passage_over_the_edge_of_a_block_of_words(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(substring_dedup.BLOCK_WORDS + 500)]
    edge = substring_dedup.BLOCK_WORDS
    rows = [(1, " ".join(words[edge - 20 : edge + 30]), "en", "a", 1), (2, " ".join(words), "en", "a", 1)]
    assert [r[2] for r in _digest(spark.createDataFrame(rows, SCHEMA))] == [0, 50]


def test_what_is_left_of_a_text(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(1, f"a  b\n{passage}", "en", "a", 1), (2, f"x {passage}\ty  z {passage} end", "en", "a", 1), (3, None, "en", "a", 1)]
    left = {r["doc_id"]: r["text_left"] for r in without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert left == {1: f"a b {passage}", 2: "x y z end", 3: ""}


def test_passages_of_nothing(no_docs):
    assert passage_digest(no_docs).collect() == []


def test_equal_hashes_of_different_words_are_told_apart():
    words = Words.of([b" ".join(b"%d" % (i + k) for i in range(WIDTH)) for k in (0, 1, 0)])
    at = np.concatenate([w[0] for w in words.windows()])
    same_hash = np.zeros(3, dtype=np.uint64)
    assert substring_dedup._least_ids(words, at, same_hash, np.array([8, 5, 9])).tolist() == [8, 5, 8]


def test_normal_texts():
    assert normal(b"\x0b a\t\tb\r\n ") == b"a b" and normal(b"") == b"" and normal(b" \n") == b""
    assert normal("a b  ".encode()) == "a b  ".encode()
