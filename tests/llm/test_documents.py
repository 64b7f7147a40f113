"""Operators on documents against brute force, on rows that are awkward on purpose."""

import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction
from math import ceil, floor, log10

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import language_model, licenses, packing, pfair, quality, simhash, toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use for results or inside.
CLASH = (
    SCHEMA + ", score double, kept string, fp string, key int, row int, slot string, place int,"
    " component string, failed_bits string, words string"
)


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = " ".join(rng.choice(words) for _ in range(80))
    near = base.split()
    near[40] = "changed"
    out = [
        None, "", " \t\n\r ", "one", "one two three", base, base, " ".join(near), base.upper(),
        "line a b c\nline a b c\nline a b c\nother", "# $ % & | < > * # # #", "é ü ñ " * 30,
        " ".join(rng.choice(words) for _ in range(6000)), "x" * 20000, "nul \x00 and \x1f   gap",
        "\U0001f600 emoji <|endoftext|> end", "a b c d e a b c d e a b c d e tail",
    ]
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(40)]
    return out


def rows():
    out = [(i, t, "en", ("a", "b", None)[i % 3], None) for i, t in enumerate(texts())]
    out += [out[5], out[5], (None, "no id here", None, None, None), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    more = (0.5, "k", "f", 1, 2, "s", 3, "c", "b", "w")
    return spark.createDataFrame([r + more for r in rows()], CLASH)


def words_of(text):
    return (text or "").encode().lower().split()


# --- quality --------------------------------------------------------------------------------


def brute_measures(text):
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines), len(lines) - len(set(lines)), len(hit),
    )


def test_quality_measures(docs):
    found = quality.judged(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if len(r["text"] or "") < 15000:
            assert tuple(r[m] for m in quality.MEASURES) == brute_measures(r["text"]), r["text"]
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (r["failed_bits"] & quality.CURRENT.mask == 0)
        assert not (r["kept"] and r["base_failed"])


def test_quality_policies_and_ablations(docs, empty):
    entries = quality.ledger(docs)
    bits = [r[0] for r in entries.select("failed_bits").collect()]
    found = {r["rule"]: r for r in quality.ablations(entries).collect()}
    mask = quality.CURRENT.mask
    for rule in quality.RULES:
        r = found[rule.name]
        assert r["n_failed"] == sum(b & rule.mask != 0 for b in bits)
        assert r["n_only"] == sum(b & mask == rule.mask for b in bits)
        assert r["n_kept"] == sum(b & mask == 0 for b in bits)
        assert r["n_kept_without"] == sum(b & mask & ~rule.mask == 0 for b in bits)
    assert [r["n_kept"] for r in quality.ablations(quality.ledger(empty)).collect()] == [0] * 6


def test_quality_clash_and_empty(clashing, docs, empty):
    kept = quality.kept_documents(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == quality.judged(docs).where("kept").count()
    judged = quality.judged(clashing)
    assert dict(judged.dtypes)["kept"] == "boolean" and judged.count() == clashing.count()
    assert quality.judged(empty).count() == 0


# --- SimHash --------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = words_of(text)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= distance:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_simhash_groups(docs, empty):
    found = simhash.groups(docs).collect()
    all_rows = docs.collect()
    prints = [brute_fingerprint(r["text"]) for r in all_rows]
    roots = brute_components(prints, 4)
    least = {}
    for r, root in zip(all_rows, roots, strict=True):
        ids = least.setdefault(root, [])
        if r["doc_id"] is not None:
            ids.append(r["doc_id"])
    wanted = sorted(
        (str(r["doc_id"]), f"{p:016x}", str(min(least[root], default=None)))
        for r, p, root in zip(all_rows, prints, roots, strict=True)
    )
    assert sorted((str(r[0]), r[1], str(r[2])) for r in found) == wanted
    assert simhash.groups(empty).count() == 0


def test_simhash_keeps_one_of_each_group(docs, clashing):
    groups = simhash.groups(docs).select("fingerprint", "component_id").distinct().collect()
    n = len({r["component_id"] for r in groups})
    for table in (docs, clashing):
        kept = simhash.deduplicated(table)
        assert kept.columns == table.columns and kept.count() == n


def test_simhash_links_every_close_pair(spark, monkeypatch):
    """Fingerprints at exactly 1 to 6 bits, and one anchor cut into many blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = random.Random(3)
    prints = []
    for _ in range(60):
        x = rng.getrandbits(64)
        prints.append(x)
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << b
            prints.append(y)
    centre = rng.getrandbits(64)
    prints += [centre ^ (1 << i) ^ (1 << j) for i in range(46, 64) for j in range(46, i)]
    prints = sorted(set(prints))
    roots = brute_components(prints, 4)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    from millrace.llm.common import components

    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = {r["node"]: r["component"] for r in components(links).collect()}
    classes = {}
    for p, root in zip(signed, roots, strict=True):
        classes.setdefault(root, set()).add(got.get(p, p))
    assert all(len(c) == 1 for c in classes.values())
    assert len({min(c) for c in classes.values()}) == len(classes)


def test_golay_code_covers():
    words = np.random.default_rng(0).integers(0, 1 << 23, 5000, dtype=np.uint32)
    home = words ^ simhash.golay_leaders()[simhash.golay_syndrome(words)]
    assert (simhash.golay_syndrome(home) == 0).all()
    assert np.bitwise_count(words ^ home).max() <= 3


# --- language model -------------------------------------------------------------------------


def brute_scores(texts, strength=200.0):
    """(n_tokens, n_known, train_tokens, base_score, score) of each text, straight from counts."""
    lists = [
        [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]
        for _, text in texts
    ]
    single, double = Counter(), Counter()
    for (learn, _), words in zip(texts, lists, strict=True):
        if learn:
            single.update(words)
            double.update(zip([None, *words], words, strict=False))
    n, v = sum(single.values()), len(single)
    out = []
    for words in lists:
        p = [(single[w] + 0.5) / (n + 0.5 * (v + 1)) for w in words]
        bigram = [
            (double[a, b] + strength * q) / (single[a] + strength)
            for a, b, q in zip([None, *words], words, p, strict=False)
        ]
        known = sum(single[w] > 0 for w in words)
        out.append((len(words), known, n, sum(map(log10, p)), sum(map(log10, bigram))))
    return out


@pytest.mark.parametrize("listed", [16, 0])
def test_language_model(docs, empty, monkeypatch, listed):
    monkeypatch.setattr(language_model, "BUCKET_TOKENS", 900)
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(language_model, "CONTEXT_TOKENS", 20)
    monkeypatch.setattr(language_model, "LISTED", listed)
    all_rows = docs.collect()
    learn = [zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 != 1 for r in all_rows]
    brute = brute_scores([(a, r["text"]) for a, r in zip(learn, all_rows, strict=True)])
    wanted = sorted((str(r["doc_id"]), not a, *b) for r, a, b in zip(all_rows, learn, brute, strict=True))
    found = sorted((str(r[0]), *r[1:]) for r in language_model.scored(docs).collect())
    for a, b in zip(found, wanted, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], abs=2e-4 * a[2])
    assert language_model.scored(empty).count() == 0


# --- packing --------------------------------------------------------------------------------


def test_packing_round_trip(docs, empty, clashing):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    encoded = {}
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        encoded.setdefault(r["doc_id"], []).append(ids)
    pieces = packing.pack(docs, TOKENIZER).collect()
    total = sum(len(ids) for some in encoded.values() for ids in some)
    assert sum(p["length"] for p in pieces) == total
    held = {}
    for p in pieces:
        ids = next(i for i in encoded[p["doc_id"]] if len(i) == p["doc_tokens"])
        part = ids[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        held.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    padding = 0
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= 1024
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding * 100 < total
    assert packing.pack(empty, TOKENIZER).count() == 0
    assert packing.pack(clashing, TOKENIZER).count() > 0


@pytest.mark.parametrize("text", [
    " " * 2_000_000, "\t" * 2_000_000, "a" * 2_000_000, "a" + " " * 1_000_000 + "b", "the " * 5000 + "\n" * 12000 + "x",
])
def test_encoder_takes_long_runs(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    assert packing.encoder(TOKENIZER)([text]) == [ids]
    assert packing.long_run(text) and not packing.long_run("some words " * 9000)


def test_encoder_equals_tokenizers(spark):
    import os

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    some = [r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect() if r[0]]
    some += [t for t in texts() if t]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
    assert packing.encoder(TOKENIZER)(some) == wanted


def test_class_lengths_fill_their_bins():
    for capacity in (1, 2, 100, 1024, 4096):
        lengths = packing.class_lengths(capacity)
        assert lengths[0] == capacity and lengths[-1] == 1
        assert all((capacity - (capacity // x) * x) * 1000 <= capacity for x in lengths.tolist())
        assert all(sum(packing.cuts(n, capacity)) == n for n in range(3 * capacity))


# --- mixing ---------------------------------------------------------------------------------


def test_mixing_places_every_row_once(docs, empty, clashing):
    weights = {"a": 3.0, "b": 1.0, "": 1.0}
    found = pfair.schedule(docs, weights, block_size=500).collect()
    assert len(found) == docs.count()
    assert len({(r["slot"], r["place"]) for r in found}) == len(found)
    blocks = {}
    for r in found:
        assert r["release"] <= r["slot"] < r["due"]
        blocks.setdefault((r["source"], r["source_block"]), set()).add(r["slot"])
    assert all(len(s) == 1 for s in blocks.values())
    slots = [min(s) for s in blocks.values()]
    assert len(slots) == len(set(slots))
    for source in ("a", "b", None):
        own = sorted((b, min(s)) for (x, b), s in blocks.items() if x == source)
        assert own == sorted(own, key=lambda p: p[1])
    assert pfair.schedule(empty).count() == 0
    mixed = pfair.mixed(clashing)
    assert mixed.columns == clashing.columns and mixed.count() == clashing.count()


def test_mixing_spreads_rows_of_one_key(spark):
    """Rows of one id, or of none, get buckets of their own, and a map column does no harm."""
    table = spark.range(5000).selectExpr(
        "if(id % 2 = 0, 7L, null) doc_id", "'s' source", "'text ' || id text", "map('k', id) m"
    )
    rows = pfair.schedule(table, block_size=100).collect()
    assert sorted(r["text"] for r in rows) == sorted(f"text {i}" for i in range(5000))
    assert len({(r["slot"], r["place"]) for r in rows}) == 5000
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["slot"], r["place"]))]
    assert 1000 < sum(i is None for i in ids[:2500]) < 1500


def test_slots_stay_in_the_windows_of_the_fluid_schedule():
    rng = random.Random(4)
    for _ in range(60):
        n = [rng.choice((1, 1, rng.randint(1, 60))) for _ in range(rng.randint(1, 25))]
        w = [Fraction(rng.randint(1, 10**6), 7 * 10**5) for _ in n]
        fluid, had, t = {}, [Fraction(0)] * len(n), Fraction(0)
        while any(a < b for a, b in zip(had, n, strict=True)):
            live = [s for s in range(len(n)) if had[s] < n[s]]
            total = sum(w[s] for s in live)
            # To the next end of a block.
            step = min((floor(had[s]) + 1 - had[s]) * total / w[s] for s in live)
            t += step
            for s in live:
                had[s] += step * w[s] / total
                if had[s].denominator == 1:
                    fluid[s, int(had[s]) - 1] = t
        found = list(pfair.slots_of(n, [float(x) for x in w]))
        assert sorted((s, b) for s, b, *_ in found) == sorted(fluid)
        for slot, (s, b, release, due) in enumerate(found):
            assert (release, due) == (floor(fluid.get((s, b - 1), 0)), ceil(fluid[s, b]))
            assert release <= slot < due


def test_mixing_keeps_to_unrounded_targets(spark):
    weights = {"a": 0.7, "b": 0.3, "c": 0.00001}
    many = {"a": 24000, "b": 12000, "c": 3}
    table = spark.createDataFrame(
        [(i, s, "x") for s, n in many.items() for i in range(n)], "doc_id long, source string, text string"
    )
    rows = pfair.schedule(table, weights, block_size=1).select("slot", "source").collect()
    order = [s for _, s in sorted(map(tuple, rows))]
    assert len(order) == sum(many.values())
    total, had = sum(weights.values()), dict.fromkeys(weights, 0)
    for t, s in enumerate(order[:34000], 1):
        had[s] += 1
        for x, w in weights.items():
            assert abs(had[x] - w / total * t) < 1, (t, x)


def test_mixing_takes_any_number_of_sources(spark):
    table = spark.range(9000).selectExpr(
        "id doc_id", "if(id < 4000, 'big', 'www' || (id % 2500) || '.example') source", "repeat('x', 10) text"
    )
    rows = pfair.schedule(table, block_size=10).collect()
    assert len({r["doc_id"] for r in rows}) == 9000
    assert sorted(r["slot"] for r in rows) == list(range(9000))
    assert all(r["release"] <= r["slot"] < r["due"] for r in rows)
    with pytest.raises(KeyError):
        pfair.schedule(table, {"big": 1.0})


# --- licences -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def license_model():
    return licenses.train()


def test_licence_lines(spark, license_model, empty, clashing):
    cases = [
        (0, "Intro text here.\nLicensed under CC BY-NC 4.0.\nMore text.", "cc-by-nc"),
        (1, "This work is licensed under the GNU General Public License, version 3.", "gpl"),
        (2, "words\n  licensed under the apache license, version 2.0", "apache-2.0"),
        (3, "Released under the MIT License.", "mit"),
        (4, "The driver lost his license and was released under a bridge.", None),
        (5, "The MIT team works under license from the public.", None),
        (6, None, None), (7, "", None), (8, "word " * 50000, None),
        (9, "a\n" * 9000 + "Released under the MIT License.", "mit"),
    ]
    table = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scanned(table, license_model).collect()}
    for i, text, family in cases:
        assert found[i]["family"] == family, text
        for span in found[i]["spans"]:
            line = text[span["start"] : span["start"] + span["length"]]
            assert "\n" not in line and line in text.split("\n")
    assert licenses.scanned(empty, license_model).count() == 0
    assert licenses.scanned(clashing, license_model).count() == clashing.count()


def test_licences_inside_long_lines(license_model):
    rng = random.Random(8)
    words = "the of and to in he was it for on as his they at be this from have one had but what".split()
    templates = licenses.template_bigrams()

    def families(line):
        return sorted(s["family"] for s in licenses.judge(license_model, line, templates)[1] if s["confirmed"])

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))

    for n in (200, 5000):
        assert families(some(n)) == []
        for family, texts in licenses.TEMPLATES.items():
            for text in texts:
                assert families(f"{some(n // 2)} {text} {some(n // 2)}") == [family], text
    both = f"{some(900)} Released under the MIT License. {some(900)} Licensed under CC BY-NC 4.0. {some(9)}"
    assert families(both) == ["cc-by-nc", "mit"]
    # At the border of two pieces.
    for n in range(licenses.STEP - 8, licenses.STEP + licenses.WINDOW + 8, 5):
        assert families(f"{some(n)} Released under the MIT License. {some(99)}") == ["mit"], n


LOOK_ALIKES = [
    ("GNU Affero General Public License, version 3", ["agpl"]),
    ("Eclipse Public License - v 2.0", ["epl"]),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", ["cc-by-nc-sa"]),
    ("CC BY-NC-SA 4.0", ["cc-by-nc-sa"]),
    ("The Unlicense", ["unlicense"]),
    ("EUPL", []),
    ("Licensed under the European Union Public Licence, version 1.2.", []),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", ["cc-by-nc-nd"]),
    ("Licensed under CC BY 4.0.", ["cc-by"]),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["cc-by"]),
    ("Licensed under the Server Side Public License, version 1.", []),
    ("Licensed under the Sun Public License, Version 1.0.", []),
    ("Licensed under the GNU Lesser General Public License, version 3.", ["lgpl"]),
    ("Licensed under the GNU Free Documentation License, version 1.3 or later.", []),
]


def test_licences_that_look_alike(license_model):
    """Each line alone and inside other words; nothing that it does not name is confirmed."""
    templates = licenses.template_bigrams()
    rng = random.Random(12)
    letters = "abdeghilmnorstu"
    wrong = []
    for line, wanted in LOOK_ALIKES:
        for size in (0, 3, 60):
            some = ["".join(rng.choices(letters, k=rng.randint(4, 8))) for _ in range(2 * size)]
            text = " ".join([*some[:size], line, *some[size:]])
            spans = licenses.judge(license_model, text, templates)[1]
            got = sorted({s["family"] for s in spans if s["confirmed"]})
            if got != wanted and (size == 0 or set(got) - set(wanted)):
                wrong.append((line, size, got))
    assert not wrong


def test_licence_names():
    assert licenses.named("under the gnu lesser general public license and cc by-nc-sa 4.0".split()) == {"lgpl", "cc-by-nc-sa"}
    assert licenses.named("the eupl or the gpl".split()) == {"", "gpl"}
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            own = licenses.named(licenses.WORD.findall(text.lower()))
            assert not own or own == {family}, text


def test_licence_confirmation_by_brute_force(license_model):
    """All windows of a line, each by its own: the family of the classifier, the shared bigrams
    counted in lists, the name looked for in a text."""
    rng = random.Random(13)
    lines = [t for t, _ in LOOK_ALIKES] + [t for some in licenses.TEMPLATES.values() for t in some]
    for _ in range(60):
        parts = [rng.choice([*lines, "and so on", "the end of the text"]) for _ in range(rng.randint(1, 3))]
        line = " ".join(parts)
        words = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", line.lower())
        possible = set()
        for a, b in licenses.windows_of(len(words)):
            p = license_model.probabilities([words[a:b]])[0]
            k = int(p[1:].argmax())
            if p[k + 1] < license_model.threshold - 1e-9:
                continue
            family = license_model.families[k]
            own = list(zip(words[a:b], words[a + 1 : b], strict=False))
            for text in licenses.TEMPLATES[family]:
                t = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())
                theirs = list(zip(t, t[1:], strict=False))
                both = [x for x in set(own) if x in theirs]
                if len(both) >= 0.6 * max(min(len(set(own)), len(set(theirs))), min(3, len(set(own)))):
                    possible.add(family)
        spans = licenses.judge(license_model, line, licenses.template_bigrams())[1]
        got = {s["family"] for s in spans if s["confirmed"]}
        assert got <= possible
        plain = f" {line.lower().replace('-', ' ')} "
        for family in got - {"reserved"}:
            # A text of its own, or a name.
            assert any(t in parts for t in licenses.TEMPLATES[family]) or any(n in plain for n in licenses.NAMES[family])


def test_windows_are_classified_as_lines_are(license_model):
    rng = random.Random(9)
    known = sorted({w for g in license_model.vocabulary for w in g.split()})
    line = [rng.choice(known) if rng.random() < 0.8 else "strange" for _ in range(300)]
    starts = np.array([rng.randint(0, 290) for _ in range(200)])
    ends = starts + np.array([rng.randint(0, 300 - s) for s in starts.tolist()])
    parts = [line[s:e] for s, e in zip(starts, ends, strict=True)]
    assert np.allclose(license_model.in_windows(line, starts, ends), license_model.probabilities(parts))


def test_licence_classifier_on_unseen_wear(license_model):
    made = licenses.examples(np.random.default_rng(99))
    p = license_model.probabilities([w for w, _ in made])
    best = np.where(p[:, 1:].max(1) >= license_model.threshold, p[:, 1:].argmax(1) + 1, 0)
    labels = np.array([y for _, y in made])
    assert (best == labels).mean() > 0.97
    assert (labels[best > 0] == best[best > 0]).mean() > 0.98


# --- toxicity -------------------------------------------------------------------------------


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in toxicity.start_weights(5).items()}
    inputs = rng.normal(size=(6, toxicity.WORD_DIM + toxicity.CHAR_DIM))
    steps = rng.integers(0, 6, (7, 4)).astype(np.int32)
    live = np.arange(7)[:, None] < np.array([7, 3, 1, 0])[None]
    y = np.array([1.0, 0.0, 1.0, 0.0])

    def loss():
        gates = toxicity.project(weights, inputs)
        z = toxicity.forward(weights, gates, steps, live).astype(np.float64)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    trace = {}
    z = toxicity.forward(weights, toxicity.project(weights, inputs), steps, live, trace)
    grads, word_error = toxicity.backward(weights, inputs, steps, live, trace, toxicity.sigmoid(z) - y)
    for name in ("wf", "ub", "cf", "bb", "aw", "ab", "av", "ow", "ob"):
        at = tuple(rng.integers(0, s) for s in weights[name].shape)
        weights[name][at] += 1e-2
        up = loss()
        weights[name][at] -= 2e-2
        down = loss()
        weights[name][at] += 1e-2
        assert grads[name][at] == pytest.approx((up - down) / 2e-2, abs=3e-3), name
    inputs[2, 3] += 1e-2
    up = loss()
    inputs[2, 3] -= 2e-2
    assert word_error[2, 3] == pytest.approx((up - loss()) / 2e-2, abs=3e-3)


def made_samples(n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("th", "an", "er", "on") for b in ("ing", "ed", "ble", "ti", "sh")]
    out = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(1, 300))]
        toxic = int(rng.random() < 0.4)
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["idiot", "vile", "scumbag"])
        out.append((" ".join(text), toxic))
    return out


@pytest.fixture(scope="module")
def toxic_model():
    return toxicity.train(made_samples(400, 1))


def test_toxicity_on_unseen_texts(toxic_model):
    samples = made_samples(150, 2)
    scores = toxicity.score_texts(toxic_model, toxicity.Words(toxic_model), [t for t, _ in samples])
    right = [(s >= 0.5) == bool(y) for s, (_, y) in zip(scores, samples, strict=True)]
    assert sum(right) > 0.95 * len(right)


def test_every_window_is_scored(toxic_model, monkeypatch):
    """Slices of a long text have exactly its windows."""
    text = made_samples(1, 7)[0][0].split() * 40
    text[5000] = "idiot"
    words = toxicity.Words(toxic_model)
    tokens = words.number([w.encode() for w in text])
    whole = toxicity.logits_of(toxic_model, words, [tokens])
    monkeypatch.setattr(toxicity, "STEP", 5)
    assert toxicity.logits_of(toxic_model, words, [tokens]) == pytest.approx(whole, abs=1e-4)
    assert all(
        sorted({p for s, n in toxicity.windows_of(k) for p in range(s, s + n)}) == list(range(k))
        for k in (0, 1, 63, 64, 65, 96, 97, 500)
    )


def test_toxicity_table(spark, docs, empty, clashing, toxic_model):
    scored = toxicity.scored(docs, toxic_model)
    assert scored.count() == docs.count()
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.scored(empty, toxic_model).count() == 0
    out = toxicity.scored(clashing, toxic_model)
    assert sorted(out.columns) == sorted(clashing.columns)
    assert dict(out.dtypes)["score"] == "double"


def test_toxicity_learns_from_the_right_rows(spark):
    samples = made_samples(60, 4)
    rows_ = [(i, t, None) for i, (t, _) in enumerate(samples)]
    table = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    # Labels of held-out rows are turned round; the model must not see them.
    marks = [(i, y if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - y) for i, (_, y) in enumerate(samples)]
    labels = spark.createDataFrame([*marks, (999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    flat = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    one, two = toxicity.fit(table, labels), toxicity.fit(table, flat)
    assert all(np.array_equal(one.weights[k], two.weights[k]) for k in one.weights)
    none = toxicity.fit(table, labels.where("toxic = 7"))
    assert toxicity.score_texts(none, toxicity.Words(none), ["x"])[0] == pytest.approx(0.5)


def test_toxicity_learns_from_long_texts(spark, monkeypatch):
    samples = made_samples(400, 11)
    longer = [(" ".join([t] + [u for u, v in samples[i : i + 12] if not v]), y) for i, (t, y) in enumerate(samples)]
    longer = [(t * (1 + 6500 // len(t)), y) for t, y in longer]
    assert min(len(t) for t, _ in longer) > toxicity.SAMPLE_CHARS
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(longer)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(longer)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda got: seen.extend(got))
    toxicity.fit(table, labels)
    known = [s for i, s in enumerate(longer) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(seen) == sorted(known)
    # Of a text beyond the bound, pieces from all over it.
    own = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1)
    words = " ".join(f"w{i:06d}" for i in range(800_000))
    one = spark.createDataFrame([(own, words)], "doc_id long, text string")
    seen.clear()
    toxicity.fit(one, spark.createDataFrame([(own, 1)], "doc_id long, toxic int"))
    (text, label), = seen
    got = [int(w[1:]) for w in text.split() if len(w) == 7 and w[0] == "w"]
    assert label == 1 and len(text) < toxicity.SAMPLE[1] * toxicity.SAMPLE_CHARS * 1.01
    assert got[0] == 0 and got[-1] == 799_999
    assert np.histogram(got, 30, (0, 800_000))[0].min() > 1000
    # Short and long texts are drawn by one rule; those beyond an even share of the characters
    # come in pieces.
    monkeypatch.setattr(toxicity, "SAMPLE", (30, 30))
    both = spark.createDataFrame(
        [(i, t) for i, (t, _) in enumerate(longer[:200] + samples[200:])], "doc_id long, text string"
    )
    seen.clear()
    toxicity.fit(both.union(both), labels)
    assert len(seen) == 60 and len(set(seen)) == 60
    far = [t for t, _ in seen if any(t[:100] in u for u, _ in longer[:200])]
    assert 15 < len(far) < 45
    for y in (0, 1):
        assert sum(len(t) for t, own in seen if own == y) <= 30 * (toxicity.SAMPLE_CHARS + toxicity.PIECES)


def test_even_share():
    assert toxicity.even_share([], 10) == 0 and toxicity.even_share([3, 4], 10) == 4
    rng = random.Random(5)
    for _ in range(200):
        sizes, total = [rng.randint(0, 50) for _ in range(rng.randint(1, 9))], rng.randint(0, 300)
        cap = toxicity.even_share(sizes, total)
        assert sum(min(cap, n) for n in sizes) <= total
        assert cap == max(sizes) or sum(min(cap + 1, n) for n in sizes) > total


def plain_score(model, text):
    """A document's score by loops over single numbers, straight from the definition."""
    w = {k: v.astype(float) for k, v in model.weights.items()}

    def gate(x):
        return 1 / (1 + np.exp(-x))

    inputs = []
    for word in re.findall(rb"[^ \t-\r]+", text.lower().encode()):
        marked = f"^{word.decode()}$"
        grams = [zlib.crc32(marked[i : i + 3].encode()) % toxicity.CHAR_ROWS for i in range(len(marked) - 2)]
        mean = sum(w["char"][g] for g in grams) / len(grams)
        inputs.append(np.concatenate([w["word"][model.words.get(word, 0)], mean]))
    logits, start = [], 0
    while True:
        window = inputs[start : start + 64]
        both = []
        for d, order in (("f", range(len(window))), ("b", range(len(window) - 1, -1, -1))):
            h, out = np.zeros(8), {}
            for t in order:
                p, q = window[t] @ w[f"w{d}"] + w[f"b{d}"], h @ w[f"u{d}"]
                r, z = gate(p[:8] + q[:8]), gate(p[8:16] + q[8:16])
                n = np.tanh(p[16:] + r * (q[16:] + w[f"c{d}"]))
                h = (1 - z) * n + z * h
                out[t] = h
            both.append(out)
        states = [np.concatenate([both[0][t], both[1][t]]) for t in range(len(window))]
        marks = [np.exp(np.tanh(s @ w["aw"] + w["ab"]) @ w["av"]) for s in states]
        pooled = sum(m * s for m, s in zip(marks, states, strict=True)) / sum(marks) if states else np.zeros(16)
        logits.append(pooled @ w["ow"] + w["ob"][0])
        if start + 64 >= len(inputs):
            return gate(model.slope * max(logits) + model.shift)
        start += 32


def test_toxicity_equals_a_plain_forward_pass(toxic_model, monkeypatch):
    texts = [t for t, _ in made_samples(25, 6)] + ["", "IDIOT", "\u00c4rger \u4f60\u597d vile"]
    wanted = [plain_score(toxic_model, t) for t in texts]
    assert toxicity.score_texts(toxic_model, toxicity.Words(toxic_model), texts) == pytest.approx(wanted, abs=1e-4)
    # Small pieces and a cache that is always full change nothing.
    monkeypatch.setattr(toxicity, "STEP", 3)
    monkeypatch.setattr(toxicity, "CACHE", 0)
    assert toxicity.score_texts(toxic_model, toxicity.Words(toxic_model), texts) == pytest.approx(wanted, abs=1e-4)


def test_long_words_are_read_in_parts(toxic_model):
    long = "x" * 3_000_000
    words = toxicity.Words(toxic_model)
    parts = " ".join(long[i : i + toxicity.LONG_WORD] for i in range(0, len(long), toxicity.LONG_WORD))
    one, two = toxicity.score_texts(toxic_model, words, [long + " idiot", parts + " idiot"])
    assert one == two and max(map(len, words.rows)) <= toxicity.LONG_WORD
    short = "y" * 1500
    assert toxicity.tokens_of(short) == [b"y" * 1024, b"y" * 476]


def test_toxicity_forgets_words_in_time(toxic_model):
    """A task's memory is bounded, however many distinct words its texts have."""
    texts = [" ".join(f"word{i}" for i in range(at, at + 1000)) for at in range(0, 160_000, 1000)]
    words = toxicity.Words(toxic_model)
    tracemalloc.start()
    toxicity.score_texts(toxic_model, words, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    assert not words.chars  # what a word is made of goes once its gates are known


def test_toxicity_sends_texts_alone_to_python(spark, toxic_model):
    """Other columns stay in Spark: this type has no counterpart in Arrow."""
    table = spark.createDataFrame([(1, "an idiot", 3), (2, None, 4)], "doc_id long, text string, n int")
    table = table.selectExpr("doc_id", "text", "make_interval(0, n) as gap")
    out = toxicity.scored(table, toxic_model).where("score <= 1")
    found = {r[0]: (r[1], r[2]) for r in out.select("doc_id", "text", F.extract(F.lit("MONTH"), "gap")).collect()}
    assert found == {1: ("an idiot", 3), 2: (None, 4)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
