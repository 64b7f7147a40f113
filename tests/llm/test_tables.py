"""Operators on embeddings, pages and conversations, and the pipeline, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import brute_components, brute_fingerprint, brute_measures

import corpus_pipeline
from millrace.llm import cover_tree, elias_fano, packing, quotations, simhash, toxicity, url_rules
from millrace.llm.common import components, forest
from millrace.llm.queries import TOKENIZER, URL_RULES

# --- cover tree -----------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 8))
    out = [base[i % 12] * rng.uniform(0.1, 5) + rng.normal(size=8) * s for i in range(150) for s in (0.05, 0.2, 1.0)]
    out += [out[3]] * 20 + [out[7] * 2.0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(out)]
    rows += [
        (1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8),
        (1004, [1.0] * 7 + [float("inf")]), (1005, [1.0, None] * 4), (1006, [1.0, 0.0]),
        (1007, [2.0, 0.0]), (1008, [-0.0, 1.0]), (1009, [0.0, 1.0]), (1e3 + 10, [1e200] * 8),
        (1011, [1e-200] * 8), (None, [1.0, 0.0]), (5, [float(x) for x in out[5]]),
    ]
    return [(None if i is None else int(i), v) for i, v in rows]


def brute_links(rows, threshold):
    def valid(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = []
    for _, v in rows:
        if valid(v):
            w = np.array(v) / np.abs(v).max()
            unit.append(w / np.linalg.norm(w))
        else:
            unit.append(None)
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None
         and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
        for i in range(n)
    ]
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            least = min([label[i], *(label[j] for j in near[i])])
            if least < label[i]:
                label[i], changed = least, True
    ids = {}
    for (key, _), own in zip(rows, label, strict=True):
        ids.setdefault(own, []).extend([] if key is None else [key])
    return sorted(
        (str(key), len(near[i]), str(min(ids[label[i]], default=None)))
        for i, (key, _) in enumerate(rows)
    )


@pytest.mark.parametrize("block", [4096, 16])
def test_cover_tree_links(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "CENTRES", 5 if block == 16 else 16384)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("x"))
    found = sorted((str(r[0]), r[1], str(r[2])) for r in cover_tree.linked(table).collect())
    assert found == brute_links(rows, 0.95)


def test_cover_tree_prunes_blocks(spark, monkeypatch):
    """Of clustered vectors most pairs of blocks are never made; nothing is lost."""
    monkeypatch.setattr(cover_tree, "BLOCK", 64)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 24))
    rows = [(i, [float(x) for x in centres[i % 30] + rng.normal(size=24) * 0.12]) for i in range(3000)]
    # A cell far larger than a block whose vectors have one direction.
    rows += [(3000 + i, [float(x) for x in centres[0] * (1 + i)]) for i in range(400)]
    made, plain = [], cover_tree._node_pairs

    def counted(blocks, pairs, threshold):
        pairs = plain(blocks, pairs, threshold).cache()
        made.append((blocks.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(cover_tree, "_node_pairs", counted)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((str(r[0]), r[1], str(r[2])) for r in cover_tree.linked(table).collect())
    assert found == brute_links(rows, 0.95)
    (blocks, pairs), = made
    assert blocks >= 50 and pairs < blocks * (blocks + 1) / 2 * 0.25, made


def test_near_order():
    rng = np.random.default_rng(10)
    points = cover_tree.unit(rng.normal(size=(8, 16))[rng.integers(0, 8, 400)] + rng.normal(size=(400, 16)) * 0.05)
    pivots = cover_tree._pivots(points, 100)
    rank = cover_tree._near_order(pivots)
    assert sorted(rank.tolist()) == list(range(len(pivots)))
    walk = pivots[np.argsort(rank)]
    assert (walk[1:] * walk[:-1]).sum(1).mean() > (pivots[1:] * pivots[:-1]).sum(1).mean()


def test_cover_tree_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.linked(table).count() == 0
    table = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, cover_tree.linked(table).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_trees_agree_with_all_pairs():
    rng = np.random.default_rng(0)
    for spread in (0.01, 0.15, 1.5):
        base = rng.normal(size=(40, 16))
        a, b = (base[rng.integers(0, 40, n)] + rng.normal(size=(n, 16)) * spread for n in (300, 200))
        one, two = cover_tree.Tree(a), cover_tree.Tree(b)
        wa, wb = rng.integers(1, 5, 300), rng.integers(1, 5, 200)
        for t in (0.95, 0.6):
            got = cover_tree.links(one, two, wa[one.order], wb[two.order], one.order, two.order, t)
            close = cover_tree.unit(a) @ cover_tree.unit(b).T >= t
            assert np.array_equal(got[0], (close @ wb)[one.order])
            assert np.array_equal(got[1], (wa @ close)[two.order])
            got = cover_tree.links(one, one, wa[one.order], wa[one.order], one.order, one.order, t)
            close = cover_tree.unit(a) @ cover_tree.unit(a).T >= t
            np.fill_diagonal(close, False)
            assert np.array_equal(got[0], (close @ wa)[one.order])


def test_unrelated_vectors_are_compared_by_their_points():
    rng = np.random.default_rng(3)
    a, b = (cover_tree.Tree(rng.normal(size=(1500, 64))) for _ in range(2))
    # Not by nodes that are about as wide as all vectors are apart.
    made = sum(len(pairs[-1]) for pairs in cover_tree._children(a, b, 0, 0, 0, 0.3162, False))
    assert made < 100


@pytest.mark.parametrize("patch, few, step", [((7, 13), 3, 5), ((256, 1024), 8, 1 << 18)])
def test_trees_of_groups_of_all_widths_agree_with_all_pairs(monkeypatch, patch, few, step):
    for name, value in (("PATCH", patch), ("FEW", few), ("STEP", step)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(4)
    spreads = [rng.choice([0.005, 0.03, 0.06, 0.1, 0.4]) for _ in range(60)]
    base = rng.normal(size=(60, 16))

    def made(n):
        return np.concatenate([
            base[k] + rng.normal(size=(rng.choice([1, 2, 3, 9, n]), 16)) * spreads[k] for k in range(60)
        ])

    a, b = made(20), made(14)
    one, two = cover_tree.Tree(a), cover_tree.Tree(b)
    wa, wb = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
    for t in (0.95, 0.7):
        na, nb, x, y = cover_tree.links(one, two, wa[one.order], wb[two.order], one.order, two.order + len(a), t)
        close = cover_tree.unit(a) @ cover_tree.unit(b).T >= t
        assert np.array_equal(na, (close @ wb)[one.order]) and np.array_equal(nb, (wa @ close)[two.order])
        p, q = np.nonzero(close)
        want = cover_tree.forest(p, q + len(a))
        tied = cover_tree.forest(x, y)
        assert all(map(np.array_equal, tied, want)) and len(p)
        got = cover_tree.links(one, one, wa[one.order], wa[one.order], one.order, one.order, t)
        close = cover_tree.unit(a) @ cover_tree.unit(a).T >= t
        np.fill_diagonal(close, False)
        assert np.array_equal(got[0], (close @ wa)[one.order])


# --- components -----------------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)]
    links += [(500, 400), (400, 500), (600, 600), (700, 701), (701, 702), (702, 700)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = dict.fromkeys(range(1, 41), 0) | dict.fromkeys(range(101, 400), 100)
    assert found == wanted | {500: 400, 701: 700, 702: 700}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_has_one_link_per_id():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 500, 2000), rng.integers(0, 500, 2000)
    ids, least = forest(a, b)
    assert len(ids) == len(set(ids.tolist())) and (least < ids).all()
    assert len(forest(np.empty(0, int), np.empty(0, int))[0]) == 0


# --- Elias-Fano -----------------------------------------------------------------------------


def test_sequences_and_tries():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (1000, 10), (5000, 10**6), (700, 2**50)):
        values = np.sort(rng.integers(0, top, n))
        blob = np.frombuffer(elias_fano.EliasFano.of(values).to_bytes(), np.uint8)
        sequence, end = elias_fano.EliasFano.read(blob, 0)
        assert end == len(blob) and np.array_equal(sequence.get(np.arange(n)), values)
        target = rng.integers(0, top + 5, 300)
        got = elias_fano.successor(sequence, np.zeros(300, int), np.full(300, n), target)
        assert np.array_equal(got, np.searchsorted(values, target))
    for order in (1, 2, 3):
        for n in (0, 1, 4000):
            tops = [20, 200, 3000][:order]
            grams = np.unique(rng.integers(0, tops, (n, order)), axis=0)
            codes = rng.integers(0, 1 << 16, len(grams)).astype(np.uint16)
            blob = np.frombuffer(elias_fano.Trie.build(list(grams.T), codes), np.uint8)
            trie = elias_fano.Trie.read(blob)
            assert np.array_equal(trie.codes, codes)
            asked = rng.integers(0, tops, (3000, order))
            where = {tuple(g): i for i, g in enumerate(grams.tolist())}
            assert trie.find(list(asked.T)).tolist() == [where.get(tuple(g), -1) for g in asked.tolist()]
            assert trie.find(list(grams.T)).tolist() == list(range(len(grams)))


# --- URL rules ------------------------------------------------------------------------------

URLS = [
    "http://example.org/es/1", "https://a.b.EXAMPLE.org/en/123?x=1", "http://example.org/en/2",
    "http://notexample.org/es/", "http://x.com/fr/a#b", "x://com/de/", "http://com", "http://org",
    "http://ORG/", "no scheme.org/es/", "", None, "http://", "://example.org/es/", "a://b://org/x",
    "http://example.org?/es/", "http://example.org/es", "http://.org/", "http://example.org./es/",
    "http://x.com/fr/" + "y" * 30000, "http://ex.org/\nline", "http://example.org/es/1",
]


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), h + p, v) for h, p, v in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    table = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    table = table.withColumn("rule", F.lit(1)).withColumn("Host", F.lit("z")).withColumn("digest", F.lit("d"))
    out = url_rules.match_rules(table, url_rules.rules_table(spark, URL_RULES))
    assert out.columns == ["page_id", "url", "digest", "host", "path", "rule", "verdict"]
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert found == {i: brute_rule(u) for i, u in enumerate(URLS)}


def test_url_rules_without_rules_or_urls(spark):
    none = spark.createDataFrame([], url_rules.RULE_SCHEMA)
    table = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r["verdict"] for r in url_rules.match_rules(table, none).collect()] == ["allow"]
    rules = url_rules.rules_table(spark, [*URL_RULES, ("org", "/", "block"), (None, "/", "block"), ("a.org", None, "block")])
    assert [r["verdict"] for r in url_rules.match_rules(table, rules).collect()] == ["block"]
    assert url_rules.match_rules(table.limit(0), rules).count() == 0


def test_url_rules_are_native(spark):
    table = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = url_rules.match_rules(table, url_rules.rules_table(spark, URL_RULES))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))


# --- quotations -----------------------------------------------------------------------------

THREAD = [
    (1, 0, "a", "Hello all.\n\nShall we meet on Friday?\nBring the report."),
    (1, 1, "b", "On Monday A wrote:\n> Shall we meet on Friday?\n\nYes, Friday suits me."),
    (1, 2, "c", "> > Shall we meet on Friday?\n> Yes, Friday suits me.\nMe too."),
    (1, 3, "a", "An unrelated thread starts here."),
    (1, 4, "b", "> bring   THE report.\n> Hello all.\nI will."),
    (1, 5, "c", ">an unrelated thread starts here.\nAnswer to that."),
    (1, 6, "d", "> words that nobody said\nStill my own text."),
    (2, 0, "a", "Shall we meet on Friday?"), (2, 1, "b", "> Yes, Friday suits me.\nNo."),
    (3, 0, "a", None), (3, 1, "b", ""), (3, 2, "c", "> \n>\n"), (None, 1, "x", "> q"), (4, None, "x", "t"),
    (5, 0, "a", "same"), (5, 0, "a", "same"), (5, 1, "b", "> same\nok"),
]
CONVERSATION = "conv_id long, turn long, role string, text string"


def test_quotation_links(spark):
    table = spark.createDataFrame(THREAD, CONVERSATION).withColumn("position", F.lit("p")).withColumn("turn2", F.lit(1))
    rows = quotations.conversations(table.repartition(4)).collect()
    assert len(rows) == len(THREAD)
    first = {r["turn"]: r for r in rows if r["conv_id"] == 1}
    assert {t: r["parent_turn"] for t, r in first.items()} == {0: None, 1: 0, 2: 1, 3: None, 4: 0, 5: 3, 6: None}
    assert {t: r["thread_turn"] for t, r in first.items()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 0, 5: 3, 6: 6}
    assert [t for _, t in sorted((r["position"], t) for t, r in first.items())] == [0, 1, 2, 4, 3, 5, 6]
    assert first[1]["body"] == "Yes, Friday suits me." and first[2]["body"] == "Me too."
    assert first[6]["body"] == "Still my own text." and first[0]["body"] == THREAD[0][3]
    assert all(r["parent_turn"] is None for r in rows if r["conv_id"] in (2, 3, 4, None))
    assert [r["body"] for r in sorted((r for r in rows if r["conv_id"] == 3), key=lambda r: r["turn"])] == ["", "", ""]
    assert sorted(r["position"] for r in rows if r["conv_id"] == 5) == [0, 1, 2]


def test_quotations_of_deeper_levels(spark):
    """The shallowest level of which a holder is found names the parent."""
    rows = [
        (1, 0, "a", "The first proposal."), (1, 1, "b", "Something else."),
        (1, 2, "c", "> > The first proposal.\nOnly a deep quote."),
        # The direct parent is not in the table; the message above it is.
        (1, 3, "d", "> A message that is lost.\n> > The first proposal.\nSo be it."),
        # The first level wins, though more words are quoted below it.
        (1, 4, "e", "> Something else.\n> > The first proposal.\n> > Only a deep quote.\nBoth."),
        (1, 5, "f", "> > > > Only a deep quote.\n> > The first proposal.\nNear before far."),
        (1, 6, "g", "> > nobody said this\nAlone."),
    ]
    found = {r["turn"]: r for r in quotations.conversations(spark.createDataFrame(rows, CONVERSATION)).collect()}
    assert {t: r["parent_turn"] for t, r in found.items()} == {0: None, 1: None, 2: 0, 3: 0, 4: 1, 5: 0, 6: None}
    assert {t: r["thread_turn"] for t, r in found.items()} == {0: 0, 1: 1, 2: 0, 3: 0, 4: 1, 5: 0, 6: 6}
    assert found[3]["body"] == "So be it."


def test_introductions():
    for line in ("On Monday, A wrote:", "  A WROTE : ", "Anna schrieb:", "Jean a \u00e9crit :", "on " + "x " * 400 + "wrote:", "wrote:"):
        assert quotations.introduces(line), line
    for line in ("On Monday, A wrote", "A rewrote:", "x " * 400 + "wrote:", "", ":", "Note:", " " * 2_000_000 + "x"):
        assert not quotations.introduces(line), line[:50]


def test_quotations_across_spans(spark, monkeypatch):
    """One long conversation that repeats a passage in most turns, cut into many spans."""
    monkeypatch.setattr(quotations, "SPAN", 4)
    rng = random.Random(8)
    rows, said = [], {}
    for turn in range(120):
        own = rng.choice(["yes indeed", "no never", f"only here {turn}"])
        text, parent = own, None
        if said and rng.random() < 0.6:
            quote = rng.choice(sorted(said))
            text, parent = f"> {quote}\n{own}", said[quote]
        rows.append((9, turn, "r", text, parent))
        said[own] = turn
    table = spark.createDataFrame([r[:4] for r in rows], CONVERSATION)
    found = {r["turn"]: (r["parent_turn"], r["position"]) for r in quotations.conversations(table).collect()}
    assert {t: p for t, (p, _) in found.items()} == {r[1]: r[4] for r in rows}
    root = {}
    for _, turn, _, _, parent in rows:
        root[turn] = root[parent] if parent is not None else turn
    order = sorted(root, key=lambda t: (root[t], t))
    assert [found[t][1] for t in order] == list(range(120))


def test_quotations_empty(spark):
    assert quotations.conversations(spark.createDataFrame([], CONVERSATION)).count() == 0


def test_quote_levels():
    assert quotations.quote_level("> > x") == (2, "x") and quotations.quote_level(">>x") == (2, "x")
    assert quotations.quote_level("a > b") == (0, "a > b")
    assert quotations.own_text("plain\n\ntext\n") == "plain\n\ntext\n"


# --- pipeline -------------------------------------------------------------------------------

SMALL = "/root/testdata/sf0.001"


def test_pipeline_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = [r[0] for r in docs.select("doc_id").collect()]
    before = len(ids)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL).cache()
        assert out.columns == docs.columns, name
        kept = [r[0] for r in out.select("doc_id").collect()]
        assert set(kept) <= set(ids) and len(kept) == len(set(kept)) <= before
        docs, before = out, len(kept)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r[0] for r in pieces.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}


def test_pipeline_on_awkward_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [None, "", "one two", "a fine text of words that differ all the time in every place here", "same text " * 3]
    rows = [(i % 7, t, None, None, None) for i, t in enumerate(texts * 3)] + [(None, "x", "en", "s", 1)]
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == table.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()


def test_pipeline_equals_brute_force(spark):
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    model = toxicity.fit(
        spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    )
    words = toxicity.Words(model)
    scores = toxicity.score_texts(model, words, [r["text"] for r in docs])
    docs = [r for r, s in zip(docs, scores, strict=True) if s < toxicity.THRESHOLD]

    def passes(text):
        n, chars, symbols, lines, repeats, covered = brute_measures(text)
        return not (
            n < 10 or 100 * covered > 20 * n or 10 * symbols > chars
            or (lines >= 4 and 2 * repeats > lines) or chars < 2 * n or chars > 20 * n
        )

    docs = sorted((r for r in docs if passes(r["text"])), key=lambda r: r["doc_id"])
    roots = brute_components([brute_fingerprint(r["text"]) for r in docs], simhash.DISTANCE)
    docs = [r for i, r in enumerate(docs) if roots[i] == i]
    encode = packing.encoder(TOKENIZER)
    wanted = {r["doc_id"]: len(ids) + 1 for r, ids in zip(docs, encode([r["text"] for r in docs]), strict=True)}
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    found = {}
    for p in pieces:
        assert p["doc_tokens"] == wanted[p["doc_id"]]
        found[p["doc_id"]] = found.get(p["doc_id"], 0) + p["length"]
    assert found == wanted
