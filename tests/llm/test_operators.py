"""The text operators on a small fixture with hard rows, against brute force."""

from __future__ import annotations

import hashlib
import html
import itertools
import math
import random
import re
import string
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brickwork.llm import common as C
from brickwork.llm import eftrie, fingerprint, minhash, mixing, packing, pages, quality, scoring, secrets, substrings, topk
from brickwork.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANDOM = "".join(random.Random(9).choices(string.ascii_letters + string.digits, k=40))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig string, words string, `key` long"


def _texts():
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base, passage = prose(120), prose(30)
    out = [None, "", "   \n ", "one", "Two words", base, base, base + " more", base.upper(), prose(40) + "\n" + passage, passage + " " + prose(50), prose(3000), passage + " " + passage]
    out += ["token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x", "secret: token: abcdefghij AKIA" + "A1B2" * 4, "a  b\t\tc\r\n d  e", "api_key=Zk3vQ9xT1mB7", "k " + RANDOM + " zzzz1111zzzz1111zzzz1111zzzz1111"]
    return out + [prose(r.randint(20, 150)) for _ in range(60)] + [base.replace(base.split()[40], "zzz", 1)]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 9 == 0 else "en", [None, "a", "b", "c"][i % 4], len(t or ""), "x", "y", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_substrings(docs, empty):
    got, seen = _rows(substrings.dedup(docs)), set()
    for i, t in enumerate(TEXTS):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if (key := tuple(w[k : k + 20])) in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (len(w), sum(gone), kept)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert substrings.dedup(empty).count() == 0


@pytest.mark.parametrize("cfg", [None, substrings.RepeatConfig(hot=1, shard=5)])
def test_substrings_of_one_doc_id_with_different_texts(spark, cfg):
    r = random.Random(4)
    prose = lambda n: " ".join(f"v{r.randrange(10**6)}" for _ in range(n))
    passage = prose(30)
    texts = [prose(10) + " " + passage + " " + prose(20), prose(70), passage + " " + prose(40), prose(50)]
    rows = [(i, t) for i in (None, 7) for t in ([*texts] if i is None else [prose(60), prose(5) + " " + passage, prose(60)])]
    docs = spark.createDataFrame([*rows, rows[1]], "doc_id long, text string")
    got = substrings.dedup(docs, cfg).collect()
    # all but one place of the passage go, whole, and nothing else
    kept = Counter(x["kept"] for x in got)
    assert len(got) == 8 and sum(x["n_removed"] for x in got) == 60
    assert all(kept[t] == (2 if t == rows[1][1] else 1) for _, t in rows if passage not in t)
    assert sum(passage in x["kept"] for x in got) == 1 and [x["doc_id"] for x in got if passage in x["kept"]] == [None]


def test_substrings_by_window_for_frequent_phrases(docs):
    cfg = substrings.RepeatConfig(hot=1, shard=5)
    a, b = (sorted((r["doc_id"], r["kept_sha256"]) for r in substrings.dedup(docs, c).collect()) for c in (cfg, None))
    assert a == b


class _Stub:
    """Stands for an automaton that locates nothing, or its first pattern at each place."""

    everywhere = False

    def __init__(self, *_):
        self.size = 0

    def add_word(self, word, _):
        self.size = len(word)

    def make_automaton(self):
        pass

    def iter(self, text):
        return [(i, 0) for i in range(self.size - 1, len(text))] if self.everywhere else []


@pytest.mark.parametrize("everywhere", [False, True])
def test_substrings_rest_on_the_automaton(monkeypatch, everywhere):
    cfg = substrings.RepeatConfig(window=3, phrase=2)
    rows = [(1, d, 0, 0, 3, False, f"a{d} x y z b{d}".encode()) for d in (5, 2)] + [(1, 9, 0, 0, 2, True, b"p q r s")]
    marks = lambda: {(d, s): f for d, _, s, _, f in zip(*substrings._shard(rows, cfg).to_pydict().values(), strict=True)}
    assert marks() == {(2, 0): 0b111, (5, 0): 0b101, (9, 0): 0b11}
    right = marks()
    monkeypatch.setattr(_Stub, "everywhere", everywhere)
    monkeypatch.setattr(substrings.ahocorasick, "Automaton", _Stub)
    assert marks() != right


def test_long_texts(spark):
    """Texts of several runs (over 1 MB) against brute force."""
    r = random.Random(6)
    prose = lambda n: " ".join(r.choice(["ab", "bb", "ccc", "é", "X"]) + str(r.randrange(90)) for _ in range(n))
    shared = prose(150_000)
    texts = [prose(430_000) + " " + shared, shared + "\n" + prose(190_000) + "\t ", "w" * 300_000 + " x", prose(30)]
    assert min(map(len, texts[:2])) > 2 * C.SLICE_BYTES and len(texts[0]) > scoring.SLICE
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got, seen = _rows(substrings.dedup(df)), set()
    for i, w in enumerate(t.split() for t in texts):
        gone = np.zeros(len(w) + 1, int)
        for k in range(len(w) - 19):
            if (key := tuple(w[k : k + 20])) in seen:
                gone[k : k + 20] = 1
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=False) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(w), gone.sum()) and got[i]["kept"] == kept
    linked = _rows(minhash.linked(df, minhash.QUERY))
    lower = [t.lower().split() for t in texts]
    assert [linked[i]["n_shingles"] for i in range(4)] == [len({tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))}) for w in lower]
    model = scoring.build(df, scoring.LanguageConfig())
    one = Counter(x for t in texts for x in [*t.lower().split(), None])
    total = sum(one.values())
    scored = _rows(scoring.scored(df, model))
    for i, t in enumerate(texts):
        base = sum(math.log10((one[x] + 1) / (total + len(one) + 1)) for x in [*t.lower().split(), None])
        assert scored[i]["n_tokens"] == len(t.split()) + 1 and scored[i]["base_score"] == pytest.approx(base, rel=1e-9) and scored[i]["score"] > base
    pieces = defaultdict(int)
    for x in packing.pieces(df, packing.PackConfig()).collect():
        pieces[x["doc_id"]] += x["length"]
    tokenizer = packing.Encoder(packing.PackConfig().path()).tokenizer
    assert pieces == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_runs_of_tokens(monkeypatch):
    """The contexts at the edges of runs, and the encoding of parts, against the whole."""
    text = " ".join(f"w{i % 7} x" for i in range(300)) + " \u00a0 \u00a0b  end\n\n"
    column = pa.array([text])
    (whole,) = scoring.Tokens.of(column, 3)
    monkeypatch.setattr(scoring, "SLICE", 50)
    parts = list(scoring.Tokens.of(column, 3))
    assert len(parts) > 10 and [len(p.first[p.own]) for p in parts] and sum(p.first.sum() for p in parts) == 1
    assert np.concatenate([p.hash[p.own] for p in parts]).tolist() == whole.hash.tolist()
    encoder = packing.Encoder(packing.PackConfig().path())
    ids = encoder.ids(column)[1].tolist()
    monkeypatch.setattr(C, "SLICE_BYTES", 20)
    assert encoder.ids(column)[1].tolist() == ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("after", [0, 2, 19])
def test_runs(after):
    r = random.Random(after)
    for text in ("", " ", "one", "a b  c\td " * 40, "x" * 90, " ".join("w" * r.randrange(1, 9) for _ in range(200)) + "\n "):
        words = WORD.findall(text)
        parts = [x[0].as_py() if isinstance(x[0].as_py(), bytes) else x[0].as_py().encode() for x in C.runs(pa.array([text]), after, 16)]
        got = [WORD.findall(p.decode()) for p in parts]
        joined = got[0] + [w for x in got[1:] for w in x[after:]]
        assert joined == words
        assert all(len(x) >= after for x in got[1:])


def test_topk(spark):
    r = np.random.default_rng(1)
    v = r.normal(size=(300, 64))
    v[50:60] = v[0]
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)] + [(None, [0.0]), (900, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for x in topk.search(df, df.where("vec_id % 100 = 0"), topk.SearchConfig(k=5)).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["distance"], x["neighbour_id"]))
    bits = v.astype(np.float32) > 0
    for q in (0, 100, 200):
        assert got[q] == sorted((int((bits[q] != b).sum()), i) for i, b in enumerate(bits))[:5]
    few = df.where("vec_id < 3")
    assert topk.search(few, few, topk.SearchConfig(k=5)).count() == 9
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("dimensions", [1, 5, 100, 200])
def test_topk_of_all_components(spark, dimensions):
    """Vectors of other lengths than a long's bits, shorter and null ones among them, that differ in the last dimensions only."""
    r = np.random.default_rng(dimensions)
    v = np.ones((80, dimensions))
    v[:, -12:] = r.normal(size=(80, min(12, dimensions)))
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)] + [(200, [1.0]), (201, []), (202, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    bits = {i: [x > 0 for x in e] + [False] * (dimensions - len(e)) for i, e in rows if e is not None}
    got = defaultdict(list)
    for x in topk.search(df, df.where("vec_id IN (0, 7, 201)"), topk.SearchConfig(k=4)).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["distance"], x["neighbour_id"]))
    for q in (0, 7, 201):
        assert got[q] == sorted((sum(a != b for a, b in zip(bits[q], e, strict=True)), i) for i, e in bits.items())[:4]


def test_packing(docs, empty):
    cfg = packing.PackConfig(capacity=256, block=64)
    tokenizer = packing.Encoder(cfg.path()).tokenizer
    by, bins = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs.unionByName(docs.where("doc_id = 9")), cfg).collect():
        by[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(TEXTS):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        rows = sorted(by[i], key=lambda r: r["piece"])[:: 2 if i == 9 else 1]
        assert [r["start"] for r in rows] == [0, *np.cumsum([r["length"] for r in rows])[:-1].tolist()] and sum(r["length"] for r in rows) == len(ids)
        assert all(r["length"] == 256 for r in rows[1:])
        for r in rows:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(n for rows in bins.values() for _, n in rows)
    assert len(bins) <= math.ceil(total / 256) * 1.06 + 1
    assert packing.pack(empty, cfg).count() == 0


def test_crossover_keeps_every_item():
    sizes = [random.Random(i).randint(1, 90) for i in range(200)]
    p = packing.evolve(sizes, [], packing.PackConfig(capacity=100, generations=5), 1)
    assert sorted(i for b in p.bins for i in b) == list(range(200)) and all(sum(sizes[i] for i in b) + f == 100 for b, f in zip(p.bins, p.free, strict=True))


def test_evolution_betters_best_fit():
    """Pieces of full sequences cut in three, which best fit packs into 45 and 439, and 3 generations of 4 without replacement into as many."""
    r = random.Random(1)
    for n, most in ((40, 42), (400, 416)):
        sizes = []
        for _ in range(n):
            a = r.randint(778, 1003)
            b = r.randint((2048 - a) // 2 - 102, (2048 - a) // 2 + 102)
            sizes += [a, b, 2048 - a - b]
        r.shuffle(sizes)
        p = packing.evolve(sizes, [], packing.PackConfig(), 1)
        assert n <= len(p.bins) <= most and sorted(i for b in p.bins for i in b) == list(range(3 * n)) and all(sum(sizes[i] for i in b) + f == 2048 and f >= 0 for b, f in zip(p.bins, p.free, strict=True))


def test_least_bins_is_never_above_a_packing():
    r = random.Random(0)
    for _ in range(60):
        sizes = [r.randint(1, 20) for _ in range(r.randint(1, 6))]
        fewest = min(len({b for b in x}) for x in itertools.product(range(len(sizes)), repeat=len(sizes)) if all(sum(s for s, b in zip(sizes, x, strict=True) if b == k) <= 20 for k in set(x)))
        assert -(-sum(sizes) // 20) <= packing.least_bins(sizes, 20) <= fewest
    assert packing.least_bins([11] * 5 + [9] * 5 + [10], 20) == 6 and packing.least_bins([11] * 5, 20) == 5


def test_elias_fano():
    r = np.random.default_rng(0)
    for universe, n in ((50, 50), (1000, 10), (10**12, 5000), (7, 1), (2**40, 3)):
        keys = np.unique(r.integers(0, universe, n, dtype=np.int64)).astype(np.uint64)
        arrays, low = eftrie.encode(keys, universe)
        ask = np.unique(np.concatenate([keys, r.integers(0, universe, 300).astype(np.uint64)]))
        where = {int(k): i for i, k in enumerate(keys)}
        assert eftrie.Sequence(arrays, len(keys), low).find(ask).tolist() == [where.get(int(k), -1) for k in ask]


def test_shards_that_cannot_be_mapped(tmp_path, monkeypatch):
    """Words of several shards are found alike where a worker holds one shard only."""
    r = np.random.default_rng(5)
    hashes = np.unique(r.integers(0, 2**64, 4000, dtype=np.uint64))
    uri, shards = f"file://{tmp_path}", 7
    shard = eftrie.shard_of(hashes, shards)
    assert all(eftrie.shard_start(s, shards) <= int(h) < eftrie.shard_start(s + 1, shards) for h, s in zip(hashes, shard.tolist(), strict=True))
    for s in range(shards):
        eftrie.build_words(uri, s, shards, hashes[shard == s], np.arange(len(hashes))[shard == s])
    ask = np.concatenate([hashes, r.integers(0, 2**64, 500, dtype=np.uint64)])
    wanted = np.concatenate([np.arange(len(hashes)), np.full(500, -1)])
    words = eftrie.Vocabulary(uri, np.bincount(shard, minlength=shards).tolist(), 1).open()
    assert words.find(ask)[0].tolist() == wanted.tolist() and words.find(hashes)[1].tolist() == list(range(len(hashes)))
    far = eftrie.Vocabulary(uri, words.sizes, 1).open()
    monkeypatch.setattr(eftrie, "HELD", 1)
    far.parts.mapped = False
    assert all(far.find(a)[0].tolist() == w.tolist() for a, w in zip(np.array_split(ask, 30) * 2, np.array_split(wanted, 30) * 2, strict=True)) and len(far.parts.open) == 1


def test_scoring(docs, empty):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in enumerate(TEXTS)}
    learnt = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    one = Counter(x for i in learnt for x in tokens[i])
    two, three = defaultdict(Counter), defaultdict(Counter)
    for i in learnt:
        w = ["<s>", *tokens[i]]
        for k in range(1, len(w)):
            two[w[k - 1]][w[k]] += 1
            if k > 1:
                three[w[k - 2], w[k - 1]][w[k]] += 1
    total, size = sum(one.values()), len(one)
    model = scoring.build(docs.where(~scoring.held_out()), scoring.LanguageConfig())
    for i, r in _rows(scoring.scored(docs, model)).items():
        w, base, score = ["<s>", *tokens[i]], 0.0, 0.0
        for k in range(1, len(w)):
            p = (one[w[k]] + 1) / (total + size + 1)
            base += math.log10(p)
            for c in (two.get(w[k - 1]), three.get((w[k - 2], w[k - 1])) if k > 1 else None):
                if c:
                    s = sum(c.values())
                    p = max(c.get(w[k], 0) - 0.75, 0) / s + 0.75 * len(c) / s * p
            score += math.log10(p)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) - 1, sum(one[x] > 0 for x in w[1:]), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and abs(r["score"] - score) < 0.05 * (len(w) - 1)
    nothing = scoring.build(empty, scoring.LanguageConfig())
    assert scoring.scored(docs, nothing).where("n_known = 0 AND train_tokens = 0").count() == len(TEXTS)
    assert scoring.scored(empty, model).count() == 0


def _form(t):
    """The canonical form, written apart from the operator's."""
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t or "").casefold())
    return re.sub(r"\s+", " ", folded).strip()


def test_fingerprints(spark, docs, empty):
    got = _rows(fingerprint.with_edits(docs))
    forms = [_form(t) for t in TEXTS]
    for i, t in enumerate(TEXTS):
        t, j = t or "", (i + 1) % len(TEXTS)
        n = TEXTS[j] or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_next"] == float(forms[i] == forms[j]) and r["near_edited"] == float(_form(edited) == forms[i]) == float(r["fingerprint"] == r["edited_fingerprint"])
        assert r["group_id"] == forms.index(forms[i])
    assert len({r["fingerprint"] for r in got.values()}) == len(set(forms))
    assert fingerprint.with_edits(empty).count() == 0 and fingerprint.with_edits(docs.where("doc_id = 5")).count() == 1
    assert fingerprint.canonical("ﬁ  Straße X") == "fi strasse x"


def test_fingerprints_of_rows_without_doc_id_and_repeated_ones(spark):
    rows = [(3, "Aa b"), (3, "Aa b"), (3, "other"), (None, "aa  B"), (None, "own"), (None, None), (7, "")]
    got = fingerprint.with_edits(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, form string, k2 long")).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["group_id"]) for r in got) == Counter([(3, 4, 3), (3, 4, 3), (3, 5, 3), (None, 5, 3), (None, 3, None), (None, 0, 7), (7, 0, 7)])


def test_fingerprints_compare_bytes(spark, monkeypatch):
    """Rows as if all forms had one digest: what differs from the first comes apart."""
    names = [x.split()[0] for x in fingerprint.SCHEMA.split(", ")]
    rows = [(i, 1, "s", "same", "e", 0.0, 0.0, i == 1, f) for i, f in ((1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "b"))] + [(6, 1, "s", "alone", "e", 0.0, 0.0, None, None)]
    made = spark.createDataFrame(rows, fingerprint.SCHEMA + ", leads boolean, form string")
    got = {r["doc_id"]: (r["group_id"], r["fingerprint"]) for r in fingerprint._compared(made).collect()}
    assert {i: g for i, (g, _) in got.items()} == {1: 1, 2: 1, 3: 3, 5: 3, 4: 4, 6: 6} and names[3] == "fingerprint"
    assert got[1][1] == got[2][1] == "same" and got[3][1] == got[5][1] != got[4][1] and len({f for _, f in got.values()}) == 4


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><a>Home</a></nav><div class="ad">buy</div>
<article><header>top</header><h1>A &amp; B</h1><p>one <b>two</b><br>three<p>caf&eacute;&nbsp;x<!-- gone --><ul><li>i<li>j</ul><form>f</form><div class="comments"><p>reader</p></div><script>var t="</p>";</script></article><footer>&copy; f</footer>"""


def test_pages(spark):
    assert pages.main_text(PAGE, frozenset()) == "A & B\none two three\ncafé x\ni\nj"
    same = "<body><div class='x'>Every page has this</div><div class='y'>{}</div></body>"
    rows = [(i, "http://h.example/%d" % i, same.format(f"own text {i}")) for i in range(12)] + [(100, None, None), (101, "http://alone/x", same.format("z")), (102, "http://h.example/q", PAGE), (103, "u", "")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    assert all(got[i] == f"own text {i}" for i in range(12))
    assert got[100] == "" and got[103] == "" and got[101] == "Every page has this\nz" and got[102].startswith("A & B\n")
    assert pages.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page,text", [
    ("<p title=it's>Hello world</p><p>second</p><p>don't go</p><p>last</p>", "Hello world\nsecond\ndon't go\nlast"),
    ('<p title="5" inch">Hello</p><p class="x">two</p>', "Hello\ntwo"),
    ('<p title="open>Hello</p><p class="x">two</p>', "Hello\ntwo"),
    ("<p title='a > b' class=\"c\">Hello</p><p title = \"x>y\"/>two", "Hello\ntwo"),
    ('<div class="social history">A chapter of it</div><p>next</p>', "A chapter of it\nnext"),
])
def test_pages_with_odd_attributes(page, text):
    assert pages.main_text(f"<html><body>{page}</body></html>", {}) == text


def test_style_tree_against_brute_force(spark):
    """Importances of 100 pages of two hosts from plain counts of blocks and child styles; a node has over 200 children."""
    r = random.Random(12)
    rows = []
    for i in range(100):
        wide = "".join(f"<p class='k{chr(97 + j % 26)}{chr(97 + j // 26)}'>x</p>" for j in range(230)) if i % 50 < 2 else ""
        kind = r.choice(["<ul><li>own {0}</li></ul>", "<p>own {0}</p>", "<div><b>same</b></div>"])
        rows.append((i, f"http://h{i % 2}/{i}", f"<body><div class='top'><p>menu</p></div><div class='text'>{kind.format(i)}<p>{r.choice(['a', 'b', i])}</p>{wide}</div></body>"))
    got = {(x["host"], x["path"]): x["importance"] for x in pages.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string"), pages.StyleConfig()).collect()}
    for h in ("h0", "h1"):
        parsed = [pages.Page(html) for _, url, html in rows if url.startswith(f"http://{h}/")]
        parsed = list({(frozenset(b[:2] for b in p.blocks), frozenset(p.styles)): p for p in parsed}.values())  # equal pages count once
        blocks, styles = defaultdict(Counter), defaultdict(Counter)
        for page in parsed:
            for path, text in {(b[0], b[1]) for b in page.blocks}:
                blocks[path][text] += 1
            for path, style in set(page.styles):
                styles[path][style] += 1
        m = math.log(len(parsed))
        assert max(len(s.split()) for x in styles.values() for s in x) > 200
        for path in {*blocks, *styles}:
            content = 1 - sum(c * math.log(c) for c in blocks[path].values()) / sum(blocks[path].values()) / m if blocks[path] else None
            n = sum(styles[path].values())
            style = sum(c / n * math.log(n / c) for c in styles[path].values()) / m if n else None
            wanted = 1.0 if content is None else content if style is None else 0.1 * style + 0.9 * content
            assert got[h, pages._id(path)] == pytest.approx(wanted, abs=1e-9)
        for path, texts in blocks.items():
            for text, c in texts.items():
                if 1 - math.log(c) / m < 0.5 and c > 1:
                    assert got[h, pages._text_id(path, text)] == pytest.approx(1 - math.log(c) / m, abs=1e-9)


def test_pages_tree_decides_inside_and_beside_an_article(spark):
    share, body = "Share this with all of your friends", "<h1>Head {0}</h1><p>Own words of {0}</p>"
    inside = f"<body><article>{body}<p>{share}</p><div><p>Best offers</p></div></article></body>"
    beside = f"<body><article><p>Teaser {{0}}</p></article><div><p>The long body text of page {{0}}</p></div><div><b>{share}</b></div></body>"
    rows = [(i, "http://in/%d" % i, inside.format(i)) for i in range(12)] + [(20 + i, "http://by/%d" % i, beside.format(i)) for i in range(12)]
    rows += [(40 + i, "http://copies/%d" % i, inside.format("one")) for i in range(9)] + [(60, "http://alone/", beside.format(60))]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Head {i}\nOwn words of {i}" for i in range(12))
    assert all(got[i] == f"Teaser {i - 20}\nThe long body text of page {i - 20}" for i in range(20, 32))
    assert all(got[i] == f"Head one\nOwn words of one\n{share}\nBest offers" for i in range(40, 49))  # one page, no evidence
    assert got[60] == f"Teaser 60\nThe long body text of page 60\n{share}"


@pytest.mark.parametrize("page", [
    "<body><div class='page has-sidebar'><article>{}</article></div></body>",
    "<body><div class='no-comments'><main>{}</main></div></body>",
    "<body><form id='aspnetForm'><article>{}</article></form></body>",
    "<body><form id='aspnetForm'><div>{}</div></form></body>",
    "<body><div class='sidebar'><article>{}</article></div></body>",
    "<body><div class='promo'><article>{}</article></div></body>",
    "<body><nav><a>Home</a><main>{}</main></nav></body>",
    "<body><article class='comments-open'>{}</article><aside><article>teaser</article></aside></body>",
])
def test_pages_noise_around_an_article(page):
    body = "<h2 id='side-effects'>Side effects</h2><section id='search-results'><p>Found</p></section><div class='notice'><p>Mind this</p></div>"
    assert pages.main_text(page.format(body), frozenset()) == "Side effects\nFound\nMind this"


def test_pages_noise_words_are_confirmed_by_the_tree(spark):
    page = "<body><article><p>Body {0}</p><div class='notice'><p>{1}</p></div><div class='comments'><p>Reader {0}</p></div></article></body>"
    rows = [(i, "http://own/%d" % i, page.format(i, f"Only here {i}")) for i in range(8)] + [(10 + i, "http://same/%d" % i, page.format(i, "We use cookies")) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Body {i}\nOnly here {i}" and got[10 + i] == f"Body {i}" for i in range(8))


def _base_spans(t):
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secrets(docs, empty):
    got = _rows(secrets.scan(docs))
    for i, t in enumerate(TEXTS):
        spans = _base_spans(t or "")
        shown = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(s[1] == k for s in spans) for k in range(3)]
    row = next(i for i, t in enumerate(TEXTS) if t and RANDOM in t)
    assert got[row]["spans"] == "random:2:42"  # random, and not the regular token after it
    clean = _rows(secrets.redact(docs))
    assert clean[row]["text"].startswith("k [SECRET] zzzz") and clean[row]["n_chars"] == len(clean[row]["text"]) and clean[0]["text"] is None
    assert clean[13]["text"] == '[SECRET]" x' and secrets.redact(docs).columns == docs.columns
    assert secrets.scan(empty).count() == 0


def test_secrets_recall_of_random_tokens(spark):
    """Random tokens of several encodings and lengths are found, identifiers and words with numbers are not."""
    r = random.Random(21)
    letters = [string.ascii_letters + string.digits, "0123456789ABCDEF", string.ascii_lowercase + string.digits, string.ascii_uppercase + "234567"]
    tokens = [t for t in ("".join(r.choices(r.choice(letters), k=r.choice([24, 32, 40, 64]))) for _ in range(600)) if re.search("[0-9]", t) and re.search("[A-Za-z]", t) and not re.search("[0-9a-f]{32}", t)]
    words = ["customer", "order", "value", "index", "total", "report", "summary", "section", "chapter"]
    others = ["_".join(r.choices(words, k=4)) + str(r.randrange(100)) for _ in range(1500)] + [f"{r.choice(words)}{i:06d}{r.choice(words)}{i:06d}" for i in range(500)]
    rows = [(i, f"see {t} there") for i, t in enumerate([*tokens, *others])]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("spans <> ''").select("doc_id", "spans").collect()
    found = {x["doc_id"] for x in got}
    assert sum(i in found for i in range(len(tokens))) >= 0.8 * len(tokens)
    assert sum(i >= len(tokens) for i in found) <= 0.01 * len(others)
    assert all(x["spans"] == f"random:4:{4 + len(tokens[x['doc_id']])}" for x in got if x["doc_id"] < len(tokens))


def test_secrets_of_many_matches_and_clashing_names(spark):
    """Places add up over several runs of matches."""
    text = " é ".join(f"AKIA{i:016d}".replace("0", "Z") for i in range(1000))
    df = spark.createDataFrame([(None, text, "r", "b", 1), (2, "clean", "r", "b", 1)], "doc_id long, text string, row string, base string, n_chars long")
    got = {x["doc_id"]: x for x in secrets.scan(df).collect()}
    spans = ",".join(f"access:{m.start()}:{m.end()}" for m in re.finditer("AKIA[A-Z0-9]+", text))
    assert got[None]["n_access"] == 1000 and got[None]["spans"] == spans and got[2]["spans"] == ""
    out = {x["doc_id"]: x for x in secrets.redact(df).collect()}
    assert out[None]["text"] == " é ".join(["[SECRET]"] * 1000) and out[None]["n_chars"] == len(out[None]["text"]) and tuple(out[2]) == (2, "clean", "r", "b", 1)


def _components(words, percent):
    sets = []
    for t in TEXTS:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_minhash(docs, empty, words, percent):
    cfg = minhash.MinHashConfig(words=words, percent=percent)
    sizes, comps = _components(words, percent)
    got = _rows(minhash.linked(docs, cfg))
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in range(len(TEXTS))] == [(n, c, c == i) for i, (n, c) in enumerate(zip(sizes, comps, strict=True))]
    assert minhash.linked(empty, cfg).count() == 0


def test_minhash_keep(docs):
    _, comps = _components(5, 80)
    kept = minhash.keep(docs.unionByName(docs.where("doc_id IN (0, 5, 9)")))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [i for i, c in enumerate(comps) if c == i]


def test_minhash_keep_without_doc_ids(spark):
    r = random.Random(8)
    prose = lambda: " ".join(f"v{r.randrange(500)}" for _ in range(60))
    own, near = [prose() for _ in range(6)], prose()
    rows = [(None, t) for t in [*own, own[0], near, near + " end", "", None]] + [(4, near.replace(near.split()[0], "x", 1)), (9, prose()), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = minhash.keep(docs).collect()
    assert sorted(x["text"] or "" for x in kept if x["doc_id"] is None) == sorted(["", "", *own])
    assert sorted(x["doc_id"] for x in kept if x["doc_id"] is not None) == [4, 9]
    got = minhash.linked(docs).where("doc_id IS NULL").collect()
    assert len(got) == 11 and sum(x["component_id"] == 4 and not x["kept"] for x in got) == 2


def test_minhash_of_a_large_near_group(spark):
    """Copies that differ from the original only, and others that are near but not linked."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        w = base[:]
        for _ in range(3 if i % 3 else 14):
            w[r.randrange(200)] = f"own{r.random()}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([*rows, (500, " ".join(base))], "doc_id long, text string")
    sets = [set(zip(*(t.split()[k:] for k in range(3)), strict=False)) for _, t in [*rows, (500, " ".join(base))]]
    ids = [*range(120), 500]
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(121):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(ids[i]), find(ids[j])
                up[max(a, b)] = min(a, b)
    got = {x["doc_id"]: x["component_id"] for x in minhash.linked(df, minhash.QUERY).collect()}
    assert got == {i: find(i) for i in ids}


@pytest.mark.parametrize("copies", [2, 8, 9, 20])
def test_minhash_rare_shingles(spark, copies):
    """Documents too far from their base, linked with those that share their changes, rare (to 8) or common."""
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for family in range(3):
        changed = [f"f{family}x{i}" if i % 12 == family else w for i, w in enumerate(base)]
        for c in range(copies):
            rows.append((len(rows), " ".join([*changed[:100], f"c{family}x{c}", *changed[101:]])))
    got = {x["doc_id"]: x["component_id"] for x in minhash.linked(spark.createDataFrame(rows, "doc_id long, text string"), minhash.QUERY).collect()}
    assert got == {i: 0 if not i else (i - 1) // copies * copies + 1 for i in range(len(rows))}


def test_minhash_rare_shingles_of_repeated_rows(spark):
    active = spark.createDataFrame([(i, i) for i in range(12)], "rep long, comp long")
    base = [f"w{i}" for i in range(100)]
    texts = [(i, " ".join([*base, *(f"own{i}x{k}" for k in range(12))])) for i in range(12)]
    reps = spark.createDataFrame([(i, 110, [0]) for i in range(12)], "rep long, size long, parity array<long>")
    once, again = (minhash._rare(active, spark.createDataFrame(t, "rep long, text string"), reps, minhash.QUERY)[0].select("rep", "rare", "done").collect() for t in (texts, [*texts, *texts[:1] * 2]))
    assert sorted(once) == sorted(again) and {(r["rare"], r["done"]) for r in once} == {(12, False)}


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 7), (50, 51), (51, 50), (60, 60)], "a long, b long")
    got = {r["node"]: r["comp"] for r in minhash.components(chain).collect()}
    assert got == {**dict.fromkeys([*range(31), 100], 0), 50: 50, 51: 50}


def test_quality(spark, docs, empty):
    r = random.Random(2)
    good = [" ".join(r.choice(["the", "cat", "sat", "on", "mat", "and"]) for _ in range(60)) for _ in range(150)]
    bad = [" ".join(r.choice(["CAT!!", "###", "$$$ x"]) for _ in range(60)) for _ in range(150)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(None, 1, 0), (9999, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = _rows(quality.classify(rows, labels))
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in got)
    assert sum(got[i]["predicted"] == (i < 150) for i in held) >= 0.97 * len(held)
    assert quality.keep(docs, labels.limit(0)).count() == len(TEXTS) and quality.classify(docs, labels.limit(0)).where("score = 0.5").count() == len(TEXTS)
    assert quality.classify(empty, labels).count() == 0 and quality.keep(docs, labels).columns == docs.columns


def test_quality_against_a_slow_convolution(monkeypatch):
    """Every chunk's maxima byte by byte, for short texts, neighbours and a long text in runs."""
    net = quality.train([], np.zeros(0), quality.QualityConfig())
    r = np.random.default_rng(4)
    net.mean, net.most = r.normal(size=16), r.normal(size=16)
    texts = [b"", b"a", b"abc" * 9, bytes(r.integers(32, 127, 64).tolist()), bytes(r.integers(32, 127, 1000).tolist())]

    def slow(text):
        x = [0] * quality.WIDTH + list(text)
        x += [0] * (-len(x) % quality.BLOCK if -len(x) % quality.BLOCK >= quality.WIDTH else -len(x) % quality.BLOCK + quality.BLOCK)
        at = lambda p: net.bias + sum(net.table[k][x[p + k] if p + k < len(x) else 0] for k in range(quality.WIDTH))
        chunk = [np.maximum(0, np.max([at(p) for p in range(b, min(b + 2 * quality.BLOCK, len(x)))], axis=0)) for b in range(0, len(x), quality.BLOCK)]
        return 1 / (1 + math.exp(-(np.mean(chunk, axis=0) @ net.mean + np.max(chunk, axis=0) @ net.most + net.offset)))

    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = quality.scores(net, net.pairs(), np.frombuffer(b"".join(texts), np.uint8), ends)
    assert got == pytest.approx([slow(t) for t in texts], abs=1e-5)
    monkeypatch.setattr(quality, "RUN", 128)
    monkeypatch.setattr(quality, "STEP", 64)
    alone = [quality.scores(net, net.pairs(), np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert alone == pytest.approx(got, abs=1e-5)


def test_mixing(docs, empty):
    assert mixing.targets([100, 100, 100], (5, 2, 1)) == pytest.approx([187.5, 75, 37.5])
    assert mixing.targets([10, 100, 1000], (5, 2, 1)) == pytest.approx([30, 300, 780])
    rows = mixing.rated(docs).collect()
    again = {r["doc_id"]: r["__mix"]["copies"] for r in mixing.rated(docs.repartition(3)).collect()}
    taken, goal = Counter(), {}
    for r in rows:
        m = r["__mix"]
        assert m["size"] == len(WORD.findall(TEXTS[r["doc_id"]] or "")) and 0 <= m["copies"] <= 3 and again[r["doc_id"]] == m["copies"]
        taken[r["source"]] += m["size"] * m["copies"]
        goal[r["source"]] = m["target"]
    assert all(abs(taken[s] - goal[s]) < 60 for s in goal)
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() == sum(again.values())
    assert mixing.rated(empty).count() == 0


def test_mixing_of_large_classes_and_clashing_names(spark):
    """One class in many parts, rows without doc_id, and columns named like the operator's own."""
    rows = [(None if i % 3 else i, f"w{i} x y", "a" if i < 900 else "b", 1, 2, 3) for i in range(1000)] + [(5, "same words here", "b", 1, 2, 3)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __size long, __mix long, __copy long").repartition(4)
    cfg = mixing.MixConfig(block=50)
    got = mixing.rated(docs, cfg).collect()
    goal = dict(zip("ab", mixing.targets([2700, 420], cfg.weights), strict=True))
    for s in "ab":
        taken = sum(r["__mix_"]["size"] * r["__mix_"]["copies"] for r in got if r["source"] == s)
        assert abs(taken - goal[s]) <= 3 * 9  # at most half a document off in each of the parts
    mixed = mixing.mix(docs, cfg)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["__mix_"]["copies"] for r in got)


def test_mix_leaves_texts_in_place(spark, tmp_path):
    """The mix's rows are those of rated, and no row with a text is shuffled."""
    rows = [(i if i % 9 else None, " ".join(["w", f"t{i % 190}", *["x"] * (i % 5)]), "ab"[i % 7 < 2], {"k": i}) for i in range(400)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows[:200], "doc_id long, text string, source string, extra map<string,int>").write.parquet(path)
    docs, cfg = spark.read.parquet(path), mixing.MixConfig(block=20)
    mixed = mixing.mix(docs, cfg)
    want = Counter()
    for r in mixing.rated(docs, cfg).collect():
        want[r["doc_id"], r["text"], r["source"], r["extra"]["k"]] += r["__mix"]["copies"]
    assert Counter((r["doc_id"], r["text"], r["source"], r["extra"]["k"]) for r in mixed.collect()) == +want
    assert "Exchange hashpartitioning" not in mixed._jdf.queryExecution().executedPlan().toString()
    same = spark.createDataFrame([(1, "a b", "s")] * 30 + [(None, "c d", "s")] * 30 + [(i, "e f g h", "t") for i in range(20)], "doc_id long, text string, source string").repartition(4)
    count = lambda x: Counter((r["doc_id"], r["text"]) for r in x)
    rated = [r for r in mixing.rated(same, cfg).collect() for _ in range(r["__mix"]["copies"])]
    assert count(mixing.mix(same, cfg).collect()) == count(rated)


def _slow_copies(rows, weights=(5.0, 2.0, 1.0)):
    """Of each source its target, from the weights and three times its size."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal, left, open_ = {}, float(sum(sizes.values())), list(order)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        if not (above := [s for s in open_ if share[s] > 3 * sizes[s]]):
            return goal | share
        for s in above:
            goal[s] = 3.0 * sizes[s]
            left -= goal[s]
            open_.remove(s)


def test_pipeline(spark, tmp_path, docs):
    """Each stage's rows against plain Python on its own input."""
    import corpus_pipeline

    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(5, 60)], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert [n.split("_")[0] for n in names] == ["quality", "minhash", "secret", "source", "best"]
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(C.written(stage(spark, steps[-1], str(tmp_path)), name))
    assert all(x.columns == docs.columns for x in steps[:-1])
    texts = [[(r["doc_id"], r["text"], r["source"]) for r in x.collect()] for x in steps[:-1]]
    # quality: the network's own probability, text by text
    net = quality.learn(docs, labels, quality.QualityConfig())
    own = lambda t: quality.scores(net, net.pairs(), np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0]
    assert 0 < len(texts[1]) < len(texts[0]) and {r[0] for r in texts[1]} == {r[0] for r in texts[0] if own(r[1]) >= 0.7}
    # near-dedup: components of what came in
    there = sorted(texts[1])
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()} for w in (WORD.findall((t or "").lower()) for _, t, _ in there)]
    up = list(range(len(there)))
    for i, j in ((i, j) for i in range(len(there)) for j in range(i)):
        if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            up = [up[j] if x == up[i] else x for x in up] if up[j] < up[i] else [up[i] if x == up[j] else x for x in up]
    assert sorted(texts[2]) == [r for i, r in enumerate(there) if up[i] == i]
    # secrets: base spans and the scan's own, replaced from the end
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan(steps[2]).collect()}
    for (i, before, _), (j, after, _) in zip(sorted(texts[2]), sorted(texts[3]), strict=True):
        edges = [tuple(map(int, s.split(":")[1:])) for s in spans[i].split(",") if s]
        assert i == j and {(a, b) for a, _, b in _base_spans(before or "")} <= set(edges)
        masked = list(before or "")
        for a, b in edges:
            masked[a:b] = ["\0"] * (b - a)
        assert re.sub("\0+", "[SECRET]", "".join(masked)) == (after or "")
    # mixing: targets, whole copies, nothing else
    goal, taken = _slow_copies(texts[3]), Counter()
    for _, t, source in texts[4]:
        taken[source] += len(WORD.findall(t or ""))
    copies = Counter(texts[4])
    assert set(copies) <= set(texts[3]) and max(copies.values()) <= 3
    longest = {s: max(len(WORD.findall(t or "")) for _, t, x in texts[3] if x == s) for s in goal}
    assert all(abs(taken[s] - goal[s]) <= max(60, longest[s] / 2) for s in goal)
    # packing: each row's tokens once, in sequences without gaps
    tokenizer, bins, pieces = packing.Encoder(packing.PackConfig().path()).tokenizer, defaultdict(list), Counter()
    for r in steps[-1].collect():
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]] += r["length"]
    wanted = Counter()
    for i, t, _ in texts[4]:
        wanted[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    assert pieces == wanted
    for rows in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(rows)]).tolist()]
        assert [o for o, _ in sorted(rows)] == ends[:-1] and ends[-1] <= 2048
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(repr, out.drop("sequence_id", "offset").collect())) == sorted(map(repr, steps[-1].drop("sequence_id", "offset").collect()))


#: Names that the operators use inside.
CLASHING = ["id", "h", "sh", "digest", "rep", "comp", "size", "n", "key", "keep", "row", "base", "tested", "spans", "cleaned", "form", "leads", "k2", "__id", "__place", "__size", "__mix", "__copy", "__part", "__score", "__digest"]


@pytest.fixture(scope="module")
def hard(spark):
    """Rows without doc_id, source or text, repeated rows, ids with several texts, and columns with the operators' own names."""
    rows = [(i, t, "a") for i, t in enumerate(TEXTS[5:14])] + [(None, TEXTS[5], None), (None, None, "b"), (None, TEXTS[9], "b"), (None, TEXTS[9], "b"), (3, TEXTS[8], "a"), (3, TEXTS[8], "a"), (3, "other words", None), (4, None, "a")]
    kind = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], kind).repartition(3).cache()


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op5", "op7", "op8", "op9", "op10"])
def test_hard_rows(spark, hard, name):
    """Every row is there once, with its doc_id, and plain frames give the same."""
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    run = {
        "op1": lambda d: substrings.dedup(d), "op3": lambda d: packing.pack(d).where("piece = 0").select("doc_id", "ids_crc32"), "op4": lambda d: scoring.scored(d, scoring.build(d, scoring.LanguageConfig())),
        "op5": lambda d: fingerprint.with_edits(d), "op7": lambda d: secrets.scan(d), "op8": lambda d: minhash.linked(d), "op9": lambda d: quality.classify(d, labels),
        "op10": lambda d: (lambda x: x.select("doc_id", F.col(x.columns[-1])["size"].alias("size"), F.col(x.columns[-1])["target"].alias("target")))(mixing.rated(d, lean=True)),
    }[name]
    ids = lambda d: Counter(r["doc_id"] for r in d.collect())
    got = run(hard)
    assert ids(got) == ids(hard)
    plain = run(hard.select("doc_id", "text", "source"))
    assert Counter(map(repr, got.collect())) == Counter(map(repr, plain.collect()))
    assert run(hard.limit(0)).count() == 0


def test_hard_rows_through_the_stages(spark, hard):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for stage in (lambda d: quality.keep(d, labels), minhash.keep, secrets.redact, mixing.mix):
        got = stage(hard)
        assert got.columns == hard.columns and got.count() > 0
        assert all(r[c] == "x" for r in got.collect() for c in CLASHING)
        assert stage(hard.limit(0)).count() == 0
    kept = minhash.keep(hard).collect()
    assert Counter(map(repr, kept)) == Counter(map(repr, minhash.keep(hard.repartition(7)).collect()))


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 11))
    assert html.unescape("&amp;") == "&" and F is not None


def test_parity_maps_bound_the_difference(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:390]), " ".join(words[200:]), " ".join(words[::2]), "one two", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    maps = {r.doc_id: r.parity for r in minhash.signatures(rows, minhash.QUERY).collect()}
    own = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} or {tuple(t.split())} for t in texts[:5]]
    assert not maps[5] and all(len(maps[i]) == minhash.PARITY_WORDS for i in range(5))
    for i in range(5):
        for j in range(5):
            differ = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(maps[i], maps[j], strict=True))
            assert differ <= len(own[i] ^ own[j]) and (differ > 0) == (i != j)
