"""Phrases, spelling variants and languages against brute force."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id, phrases, variants

LONG = "the same long line of words here and there and here "


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- phrases ----------------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    found, words = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    found[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, f in found.items():
        many = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        kept = []
        for p, a in many.items():
            if any(
                100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in many.items() if len(q) > len(p)
            ):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "é", "Ñu", "x\x01y", "d e", "#", "a", "b"]
    rows = [
        (rng.choice(["en", "fr", None]), "".join(
            rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", "\x0b", "\x1c "])
            for _ in range(rng.randrange(60))
        ))
        for _ in range(150)
    ]
    rows += [("en", None), (None, None), ("en", ""), (None, " \t. "), ("en", "x " * 3000)]
    return rows + [("en", LONG * 3)] * 60


@pytest.mark.parametrize("least, top", [(3, 40), (30, 2000)])
def test_phrases(spark, least, top):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(docs, least, top).collect())
    assert got == brute_phrases(rows, least, top) and got


def test_phrases_in_small_blocks_and_chunks(spark, monkeypatch):
    """Blocks, chunks and parts of any size give the same; hot prefixes go deeper."""
    rows = phrase_rows()
    text = (LONG * 200)[:-1]
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 64)
    assert b"".join(phrases._chunks(text.encode())) == text.encode()
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 300)
    batches = [
        phrases.pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    ]
    blocks = list(phrases._blocks(iter(batches)))
    assert len(blocks) > 10
    n = collections.Counter()
    for block in blocks:
        row = block.to_pylist()[0]
        n[row["lang"]] += row["n"]
        words = phrases._split(row["vocabulary"])
        rows_, weights = phrases._merged(phrases._suffixes(phrases._unpacked(row["codes"], np.int32)))
        assert weights.sum() == row["n"]
        hot = {(b"the",), (b"the", b"same"), (b"x",)}
        index = phrases.hot_index({lang: hot for lang in ("en", "fr", "und")})
        part, depth = phrases._route(row["lang"], rows_, words, index, 7)
        below = collections.defaultdict(set)
        for r, p, d in zip(rows_, part, depth):
            prefix = tuple(words[c] for c in r[:d])
            assert prefix not in hot and all(prefix[:k] in hot for k in range(1, d))
            below[prefix].add(p)
        assert all(len(parts) == 1 for parts in below.values())
    want = collections.Counter()
    for lang, text in phrase_rows():
        want[lang or "und"] += len([t for t in phrases.tokens(folded(text).encode()) if t != b"."])
    assert {k: v for k, v in n.items() if v} == {k: v for k, v in want.items() if v}


def test_phrases_of_many_hot_prefixes(spark, monkeypatch):
    """Parts that hardly take a prefix: nearly all are counted from the blocks or go deeper."""
    monkeypatch.setattr(phrases, "PART_SHARES", 100)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert sorted(tuple(r) for r in phrases.collocations(docs, 3, 90).collect()) == brute_phrases(rows, 3, 90)


def test_multikey_quicksort_counts_prefixes():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 4, (4000, 4)).astype(np.int32)
    rows[:, 0] += 1
    for k in range(1, 4):
        rows[:, k] *= rows[:, k - 1] != 0
    weights = rng.integers(1, 4, 4000)
    want = collections.Counter()
    for row, w in zip(rows.tolist(), weights.tolist()):
        for k in range(1, 5):
            if row[k - 1]:
                want[tuple(row[:k])] += w
    got = {
        tuple(p): int(c)
        for ps, cs in phrases.sorted_phrases(rows, weights, np.ones(4000, np.int8), 90)
        for p, c in zip(ps.tolist(), cs)
    }
    assert got == {p: c for p, c in want.items() if c >= 90}


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string, f long, words string")
    assert phrases.collocations(empty).collect() == []
    none = spark.createDataFrame([(None, None, 1)], "lang string, text string, rank long")
    assert phrases.collocations(none).collect() == []


# --- spelling variants ------------------------------------------------------------------------


def brute_words(rows):
    found = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = folded(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_variants(words):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def variant_rows():
    rng = random.Random(8)
    stems = ["color", "aaaaa", "ababab", "straße", "naïveté", "grammars", "pqrstu", "zzzzzzz"]

    def worn(word):
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(word) + 1)
            word = rng.choice([word[:i] + rng.choice("abzé") + word[i:], word[:i] + word[i + 1:], word])
        return word

    rows = [
        (rng.choice([None, i, 7]), " ".join(worn(rng.choice(stems)).title() for _ in range(rng.randrange(80))))
        for i in range(120)
    ]
    return rows + [(1, None), (None, None), (2, ""), (3, "12 ×÷ 34"), (4, "Ångström÷" * 50)]


def test_variants(spark):
    rows = variant_rows()
    docs = spark.createDataFrame(
        [(k, t, 1, "w") for k, t in rows], "doc_id long, text string, n long, word string"
    ).repartition(4)
    words = brute_words(rows)
    got = sorted((tuple(r) for r in variants.variants(docs).collect()))
    assert got == brute_variants(words)
    assert sum(r[4] for r in got) > 100 and any(r[1] != r[2] for r in got if r[1])


def test_held_words_go_out_in_parts(monkeypatch):
    rows = variant_rows()
    monkeypatch.setattr(variants, "HELD_WORDS", 5)
    batch = variants.pa.RecordBatch.from_pydict(
        {"k": ["" if k is None else str(k) for k, _ in rows], "t": [t for _, t in rows]}
    )
    found = collections.Counter()
    for part in variants._count(iter([batch])):
        for word, n in zip(*[c.to_pylist() for c in part.columns]):
            found[word] += n
    assert {w: n for w, n in found.items() if n >= 3} == brute_words(rows)


@pytest.mark.parametrize("rare", [0, 2, 20, 10**6])
def test_bound_covers_every_edit(rare):
    """No edit takes more grams from a word than its bound, and near words share a list."""
    rng = random.Random(rare)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 10))) for _ in range(300)]
    grams = variants.Grams.of(words[:200], rare)
    for word in words:
        spans = grams.split(word)
        bound = grams.bound(word, spans)
        own = collections.Counter((variants.LEFT + word + variants.RIGHT)[s:e] for s, e in spans)
        lists = {(g, at, len(word)) for g, at in grams.listed(word)}
        for i in range(len(word) + 1):
            edits = [word[:i] + c + word[i:] for c in "abcz"]
            if i < len(word):
                edits += [word[:i] + c + word[i + 1:] for c in "abcz"] + [word[:i] + word[i + 1:]]
            for other in edits:
                if other == word or len(other) < 5:
                    continue
                marked = variants.LEFT + other + variants.RIGHT
                theirs = collections.Counter(marked[s:e] for s, e in grams.split(other))
                assert sum((own - theirs).values()) <= bound
                short, long = sorted((word, other), key=len)
                d = len(long) - len(short)
                ours = {(g, at) for g, at in grams.listed(short)}
                far = {(g, at) for g, at in grams.listed(long)}
                assert any((g, at + s) in far for g, at in ours for s in {0, d})
        assert lists


def test_chains_lead_to_their_root(spark):
    chain = ["abcdefgh"[:5 + i] for i in range(4)] + ["abcdefghi", "abcdefghij"]
    words = [(w, 3 * 2**i) for i, w in enumerate(chain)] + [("lonely", 3), ("abcdx", 6)]
    got = {r["word"]: r for r in variants.grouped(spark.createDataFrame(words, "word string, n long")).collect()}
    assert {got[w]["root"] for w in chain} == {"abcdefghij"}
    assert got["lonely"]["n_near"] == 0 and got["lonely"]["form"] is None and got["lonely"]["root"] == "lonely"
    # Twice as frequent is enough; of equally frequent near words the first one is the form.
    assert got["abcde"]["form"] == "abcdef"


def test_variants_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(empty).collect() == []


# --- languages --------------------------------------------------------------------------------

SYLLABLES = {"en": "the and ing tion er th", "de": "der ung ein sch ver keit", "fr": "le eau oi ç é ment"}


def sentence(rng, lang, size=40):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(size))


def language_rows():
    rng = random.Random(2)
    rows = [(i, sentence(rng, lang), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(SYLLABLES), 600))]
    return rows + [
        (None, None, "en"), (1000, None, None), (1001, "", "en"), (1002, "1234 !!", "de"), (1003, "\n", None),
        (1004, sentence(rng, "fr", 20000), None), (1005, sentence(rng, "de"), None),
    ] + [(7, sentence(rng, "en"), "en")] * 50


def test_languages(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("SCORE", F.lit("x"))
    known = language_id.learn(docs)
    assert sorted(known) == ["de", "en", "fr"]
    assert all(0 < len(d) <= language_id.DICTIONARY_BYTES for d in known.values())
    got = language_id.identified(docs.select("doc_id", "text", "SCORE"), known)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    found = got.collect()
    assert len(found) == len(rows)
    held = [
        (r, lang) for r, (key, _, lang) in zip(found, rows)
        if lang and r["lang_pred"] != "und" and zlib.crc32(str(key).encode()) % 4 == 2
    ]
    assert np.mean([r["lang_pred"] == lang for r, lang in held]) > 0.98
    for r in found:
        assert 0 <= r["score"] <= 1
        blank = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == blank
    by_id = {r["doc_id"]: r["lang_pred"] for r in found}
    assert by_id[1004] == "fr" and by_id[1005] == "de"


def test_sizes_are_those_of_plain_compression(spark):
    """Sum over windows, each compressed on its own with a fresh dictionary."""
    rng = random.Random(4)
    contents = {lang: sentence(rng, lang, 500).encode() for lang in SYLLABLES}
    known = language_id.compressors(contents)
    text = sentence(rng, "en", 700).title()
    want = []
    for lang in sorted(contents):
        total = 0
        data = text.lower().encode()
        for at in range(0, len(data), language_id.WINDOW):
            settings = language_id.zstandard.ZstdCompressionParameters(**language_id.SETTINGS)
            content = language_id.zstandard.ZstdCompressionDict(
                contents[lang], dict_type=language_id.zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(compression_params=settings)
            one = language_id.zstandard.ZstdCompressor(compression_params=settings, dict_data=content)
            total += len(one.compress(data[at:at + language_id.WINDOW] + language_id.FILL))
        want.append(total)
    assert language_id.sizes_of(text, known).tolist() == want
    assert language_id.judge(text, known)[0] == "en"


def test_narrow_margins_are_rejected():
    same = language_id.compressors({"a": b"some text", "b": b"some text"})
    assert language_id.judge("word of a text", same) == ("a", 0.5, True)
    assert language_id.judge("word", language_id.compressors({"a": b"some text"})) == ("a", 1.0, False)


def test_languages_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.learn(empty) == {}
    assert language_id.identified(empty, {}).collect() == []
    row = spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")
    assert language_id.identified(row, language_id.learn(row)).first()["lang_pred"] == "und"
