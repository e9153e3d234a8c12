"""Mixing, quality rules, secrets, sharding and language ID against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm.crf import Labeller, expected_moves, fit, forward_backward, words_of
from assayer.llm.language import identify, languages
from assayer.llm.mixing import mix, taken_copies
from assayer.llm.quality_rules import judge_quality, without_frequent_lines
from assayer.llm.secrets import RULES, find_secrets, read_ledger, redacted, scan_unseen, secret_digest
from assayer.llm.sharding import MULTIPLIER, assign_shards, jump_shard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Mixing


def _targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and left * weight[s] / total > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else left * weight[s] / total for s in names}
        full |= over


def test_mix_meets_targets_and_limits(spark, odd_docs, odd_rows, no_docs):
    rows = mix(odd_docs).collect()
    sizes = defaultdict(int)
    for _, text, _, source, _ in odd_rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets, of = _targets(sizes), {r[0]: r[3] for r in odd_rows}
    taken = defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(targets[of[r.doc_id]]) and r.source_size == sizes[of[r.doc_id]]
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2
        taken[of[r.doc_id]] += r.taken
    # One source is little more than a single long document, which is taken once or twice.
    longest = {s: max(len(WORD.findall(r[1] or "")) for r in odd_rows if r[3] == s) for s in sizes}
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(2, 0.02 * target, longest[source] / 2 if longest[source] > sizes[source] / 2 else 0)
    assert sorted(map(tuple, mix(odd_docs.repartition(5)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mix(no_docs).count() == 0


def test_mix_is_exponentially_tilted(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 90), "ab"[i % 2]) for i in range(400)], "doc_id bigint, text string, source string")
    rows = [r for r in mix(docs, weights=(1.0, 9.0)).collect() if 0 < r.rate < 2 and r.size]
    slopes = defaultdict(set)
    for r in rows:
        slopes[r.target].add(round(np.log(r.rate) / r.size, 9))
    assert slopes and all(len(s) == 1 for s in slopes.values())


def test_taken_copies_has_every_column_and_the_same_words(spark, odd_docs):
    rows = taken_copies(odd_docs)
    assert rows.columns == odd_docs.columns
    words = sum(len(WORD.findall(r.text or "")) for r in rows.collect())
    assert words == mix(odd_docs).agg(F.sum("taken")).first()[0]


# Quality rules


def _judge(rows):
    out, norm = {}, lambda line: re.sub("[0-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" "))
    texts, holds = defaultdict(set), defaultdict(set)
    for _, text, _, host, _ in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                holds[host, norm(line)].add(text or "")
    for key, text, _, host, _ in rows:
        text = text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
        gone = sum(len(WORD.findall(x)) for x in lines if len(holds[host, norm(x)]) > max(10, 0.1 * len(texts[host])))
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        stats = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), gone, failed)
        out[key] = (*stats, not failed and len(words) - gone >= 0.5 * len(words))
    return out


def test_quality_rules_against_plain_python(spark, odd_rows, no_docs):
    rng = random.Random(5)
    header = " ".join(f"item{i}" for i in range(40))
    lines = [(100 + i, "\n".join(["Menu  12 | " + header] + [" ".join(f"w{rng.randint(0, 40 * (i % 4 + 1))}" for _ in range(rng.choice((4, 20, 60))))] * rng.randint(1, 3)), "en", "h", 1) for i in range(60)]
    rows = [*odd_rows, *lines, *lines[:2]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("line", F.lit(1))
    got = judge_quality(docs).collect()
    want = _judge(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id], r
    assert any(r.n_removed_words for r in got) and any(not r.kept and not r.base_failed for r in got)
    assert judge_quality(no_docs).count() == 0


def test_texts_without_frequent_lines(spark, odd_docs, odd_rows, no_docs):
    rows = [(i, f"own {i}\n\n Page  {i % 10}\nend {i}\npage 7\n", "en", "a", 1) for i in range(12)]
    rows += [(3, rows[3][1], "en", "a", 1), (3, rows[3][1], "en", "b", 1), (50, "page 1", "en", "a", 1), (None, "x\nPAGE 3\ny", "en", "a", 1), (51, None, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    got = without_frequent_lines(docs).collect()
    want = [(i, f"own {i}\n\nend {i}\n", "a") for i in [*range(12), 3]] + [(3, rows[3][1], "b"), (50, "", "a"), (None, "x\ny", "a"), (51, None, "a")]
    assert Counter((r.doc_id, r.text_left, r.source) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    left = without_frequent_lines(odd_docs)
    assert left.columns == [*odd_docs.columns, "text_left"] and left.count() == len(odd_rows)
    assert without_frequent_lines(no_docs).count() == 0



# Secrets


def test_long_lines_have_a_limit_that_does_not_grow_with_the_host(spark):
    from assayer.llm.quality_rules import LineLimit

    long, short = "one two three four five six seven eight", "page next"
    # Digits are all alike to the rule, so lines of one document only differ in letters.
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    own = lambda i: " ".join(f"{name(i)}x{name(k)}" for k in range(60))
    rows = [(i, f"{own(i)}\n{long if i < 40 else ''}\n{short if i < 40 else ''}", "a") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    removed = {r.doc_id: r.n_removed_words for r in judge_quality(docs, limit=LineLimit(most=30)).collect()}
    assert {removed[i] for i in range(40)} == {8} and {removed[i] for i in range(40, 600)} == {0}
    assert {r.n_removed_words for r in judge_quality(docs).collect()} == {0}
    shared = [" ".join(f"{name(k)}q{name(j)}" for j in range(8)) for k in range(20)]
    depleted = [(i, "\n".join([own(i), *shared]), "a") for i in range(50)]
    kept = judge_quality(spark.createDataFrame(depleted, "doc_id bigint, text string, source string")).select("kept", "base_failed").distinct().collect()
    assert [tuple(r) for r in kept] == [(False, False)]


def test_secret_digest_against_plain_python(spark, odd_docs, odd_rows, no_docs, tmp_path):
    base = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    ]
    got = secret_digest(odd_docs, str(tmp_path / "ledger")).collect()
    texts = {i: t or "" for i, t, *_ in odd_rows}
    assert len(got) == len(odd_rows)
    for r in got:
        found = sorted((m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(base) for m in p.finditer(texts[r.doc_id]) if len(m[g]) >= n)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{base[k][0]}:{s}:{e}" for s, k, e in found).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in found) for i in range(3))
    assert secret_digest(no_docs, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("TOKEN: abcdef", [("assign@1", 0, 13)]),
        ("toKen=abcdef", []),
        ("token=abc token=abcdef", [("assign@1", 10, 22)]),
        ("ñ AKIA" + "B" * 16, [("access@1", 2, 22)]),
        ("f" * 23, []),
        ("-----BEGIN RSA PRIVATE KEY-----", [("pem@1", 0, 31)]),
    ],
)
def test_find_secrets(text, spans):
    assert find_secrets(text) == spans


def test_ledger_scans_only_what_it_lacks(spark, tmp_path):
    ledger, schema = str(tmp_path / "ledger"), "path string, version int, text string"
    first = spark.createDataFrame([("a", 1, "token=abcdef"), ("b", 1, "clean"), ("c", 1, "token=abcdef")], schema)
    scan_unseen(first, ledger, RULES[:2], key="path")
    assert read_ledger(spark, ledger).count() == 2
    scan_unseen(first, ledger, RULES[:2], key="path")
    assert read_ledger(spark, ledger).count() == 2
    later = first.unionByName(spark.createDataFrame([("a", 2, "f" * 24)], schema))
    scan_unseen(later, ledger, RULES[:2], key="path")
    assert read_ledger(spark, ledger).count() == 3
    # A new rule is applied to all blobs, the old ones are not applied again.
    scan_unseen(later, ledger, RULES[:3], key="path")
    rows = read_ledger(spark, ledger).collect()
    assert Counter(tuple(r.rules) for r in rows) == {("assign@1", "access@1"): 3, ("hex@1",): 3}
    assert {f.rule for r in rows for f in r.found} == {"assign@1", "hex@1"}


@pytest.mark.parametrize(
    ("rule", "text", "spans"),
    [
        ("pem", "x -----BEGIN RSA PRIVATE KEY----- y -----BEGIN PUBLIC KEY-----", [(2, 33)]),
        ("github", "ghp_" + "a" * 36 + " ghx_" + "a" * 36 + " gho_" + "a" * 35, [(0, 40)]),
        ("slack", "xoxb-1234567890 xoxz-1234567890 xoxp-123", [(0, 15)]),
        ("jwt", "eyJabcdefgh.eyJabcdefgh.abcdefgh eyJa.eyJb.c", [(0, 32)]),
        ("url", "see https://me:pass@host and http://host:80/a@b", [(4, 20)]),
        ("url", "9http://u:p@x", [(1, 12)]),
        ("url", "://u:p@x 12://u:p@x", []),
        ("url", "a" * 200 + "://" + "u" * 300 + ":" + "p" * 500 + "@h", [(0, 1005)]),
        ("url", "ftp://a:b@c://d:e@", [(0, 10), (10, 18)]),
    ],
)
def test_each_further_rule(rule, text, spans):
    only = tuple(r for r in RULES if r.name == rule)
    assert [(start, end) for _, start, end in find_secrets(text, only)] == spans


def test_long_runs_without_a_match_are_read_once():
    text = "a" * 200_000 + " ://" + "u:" * 50_000
    assert find_secrets(text, tuple(r for r in RULES if r.name == "url")) == []


def test_a_second_scan_of_a_table_adds_only_what_is_new(spark, odd_docs, odd_rows, tmp_path):
    ledger = str(tmp_path / "ledger")
    base = tuple(r for r in RULES if r.name in ("assign", "access", "hex"))
    blobs = len({text or "" for _, text, *_ in odd_rows})
    scan_unseen(odd_docs, ledger, base)
    spans = {r.doc_id: r.spans for r in secret_digest(odd_docs, ledger).collect()}
    scanned = Counter(rules for _, rules in {(r.blob, tuple(r.rules)) for r in read_ledger(spark, ledger).collect()})
    assert scanned == {tuple(r.id for r in base): blobs, tuple(r.id for r in RULES if r not in base): blobs}
    for doc_id, text, *_ in odd_rows:
        assert spans[doc_id] == ",".join(f"{rule.partition('@')[0]}:{start}:{end}" for rule, start, end in find_secrets(text or ""))


def test_redacted_keeps_rows_and_columns(spark, odd_docs, odd_rows, tmp_path):
    rows = redacted(odd_docs, str(tmp_path / "ledger"))
    assert rows.columns == odd_docs.columns
    texts = {r.doc_id: r.text for r in rows.collect()}
    # The quote after the value belongs to no match; a password of five letters is none.
    assert texts[31] == 'a [secret]" and [secret] [secret] password:short'
    assert all(texts[i] == t for i, t, *_ in odd_rows if i != 31)
    assert rows.count() == len(odd_rows)


# Sharding


def _jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_jump_shard_is_the_published_function(spark, shards):
    rows = spark.range(400).withColumn("k", F.xxhash64("id")).select("k", jump_shard(F.col("k"), shards).alias("s")).collect()
    assert all(_jump(r.k % (1 << 64), shards) == r.s for r in rows)


def test_shards_are_gapless_and_grow_into_the_new_one_only(spark, odd_docs, odd_rows, no_docs):
    rows = assign_shards(odd_docs, 3).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 3) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert assign_shards(no_docs, 3).count() == 0


def test_large_groups_are_numbered_in_buckets(spark):
    from assayer.llm.common import numbered

    df = spark.range(20_000).selectExpr("id", "IF(id % 3 = 0, NULL, id % 2) AS g", "xxhash64(id) AS h")
    rows = numbered(df, ["g"], "h", ["id"], "n").collect()
    want = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.h, r.id)):
        want[r.g].append(r.id)
    assert len(rows) == 20_000 and all(want[r.g][r.n] == r.id for r in rows)


# Language


def _texts(n: int, seed: int) -> list[tuple[str, str]]:
    rng, parts = random.Random(seed), {"en": ["the", "ing", "th", "er", "wh", "ly"], "de": ["der", "sch", "ung", "ß", "ein", "ü"], "fr": ["eau", "é", "oi", "les", "que", "ç"]}
    word = lambda lang: "".join(rng.choices(parts[lang], k=rng.randint(1, 3)))
    return [(lang, " ".join(word(lang) for _ in range(rng.randint(5, 60)))) for lang in rng.choices(list(parts), k=n)]


@pytest.fixture(scope="module")
def model():
    texts = _texts(150, 1)
    return fit([words_of(t) for _, t in texts], [lang for lang, _ in texts], rounds=30)


def test_forward_backward_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(6, 2, 3)), rng.normal(size=(3, 3))
    chance, *factors = forward_backward(scores, np.array([2, 6]), moves)
    want_pairs = np.zeros((3, 3))
    for k, length in enumerate((2, 6)):
        paths = list(product(range(3), repeat=length))
        weight = np.array([np.exp(sum(scores[t, k, p[t]] for t in range(length)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        share = weight / weight.sum()
        for t in range(length):
            assert chance[t, k] == pytest.approx([sum(s for p, s in zip(paths, share) if p[t] == i) for i in range(3)])
        for p, s in zip(paths, share):
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += s
    assert expected_moves(*factors, moves) == pytest.approx(want_pairs)
    assert (chance[2:, 0] == 0).all()


def test_words_of_code_switched_text_get_their_own_languages(model):
    (_, german), (_, french) = [next(x for x in _texts(200, 4) if x[0] == lang and len(x[1].split()) > 20) for lang in ("de", "fr")]
    words = [words_of(german)[:20], words_of(french)[:20]]
    chances = Labeller(model).word_chances([words[0] + words[1]])[0]
    named = [model.labels[i] for i in chances.argmax(axis=1)]
    assert named[:20].count("de") >= 18 and named[20:].count("fr") >= 18


def test_language_of_held_out_texts(spark, no_docs):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(_texts(200, 9))] + [(900, None, "en"), (901, "12 ² !", "en"), (902, "the thing", None), (None, "der", "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in languages(docs).collect()}
    assert len(got) == len(rows)
    for i, _, lang in rows[:200]:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [(got[i].lang_pred, lang) for i, _, lang in rows[:200] if got[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901))
    assert got[902].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values()) and not got[None].held_out
    assert languages(no_docs).count() == 0
    assert identify(docs, None).select("lang_pred").distinct().first()[0] == "und"


def test_every_letter_of_a_long_run_counts(spark):
    rng = random.Random(4)
    chinese = lambda n: "".join(chr(0x4E00 + rng.randrange(300)) for _ in range(n))
    assert [len(w) for w in words_of("x" * 95 + " ab")] == [40, 40, 15, 2]
    rows = [(i, chinese(300) if i % 2 else t, "zh" if i % 2 else "en") for i, (_, t) in enumerate(x for x in _texts(400, 5) if x[0] == "en")]
    odd = [(1000, chinese(2000) + " the thing", None), (1001, chinese(40) + " " + "thing " * 400, None), (1002, "wh" * 40_000, None)]
    docs = spark.createDataFrame(rows + odd + odd, "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in languages(docs).collect()}
    assert got[1000][0] == "zh" and got[1000][1] > 0.95
    assert got[1001][0] == "en" and got[1002][0] == "en"


def test_the_sample_is_of_different_texts_and_of_all_languages(spark, monkeypatch):
    from assayer.llm import language

    taken = []
    monkeypatch.setattr(language, "fit", lambda texts, labels: taken.append(Counter(labels)) or "model")
    texts = _texts(300, 6)
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts)]
    rows += [(10_000 + i, "one hot text", "en") for i in range(500)]
    rows += [(20_000 + i, f"very long {i} " * 2_000, "xx") for i in range(9)]
    usable = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    assert language.train(docs, per_language=20) == "model" and language.train(docs.limit(0)) is None
    different = {lang: len({t for _, t, other in usable if other == lang}) for lang in ("en", "de", "fr", "xx")}
    assert taken == [Counter({lang: min(20, n) for lang, n in different.items()})]
