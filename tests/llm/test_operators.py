"""Every registered query on odd and empty tables, and each against a plain reference."""

import base64
import hashlib
import math
import os
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from cellwatch.llm import bpe, html, licenses, neardup, quality, sharding, toxicity, treeweight, warc
from cellwatch.llm.queries import ORACLES, QUERIES
from checks.compare import connect

from .conftest import doc, write_tables

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id held_out score predicted",
    "op5": "page_id payload_bytes payload_digest record_type refers_to",
    "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "doc_id n_shingles component_id kept",
    "op8": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10": "page_id url text n_chars",
    "op11": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op12": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


@pytest.fixture(scope="module")
def odd(spark, odd_dir):
    """Results of all queries on the odd tables, by operator."""
    return {n.split("_")[0]: [r.asDict() for r in f(spark, odd_dir).collect()] for n, f in QUERIES.items()}


@pytest.fixture(scope="module")
def odd_docs(spark, odd_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").collect()]


def test_columns_and_row_counts(spark, odd, odd_dir):
    sizes = {t: spark.read.parquet(f"{odd_dir}/{t}.parquet").count() for t in ("documents", "pages")}
    for op, names in COLUMNS.items():
        # op11 has a row for each piece
        assert op == "op11" or len(odd[op]) == sizes["pages" if op in ("op5", "op10") else "documents"], op
        assert list(odd[op][0])[:len(names.split())] == names.split(), op


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    df = QUERIES[name](spark, empty_dir)
    assert df.collect() == [] and df.columns[:3] == COLUMNS[name.split("_")[0]].split()[:3]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    if not os.path.isdir(SMALL):
        pytest.skip("no test data")
    cursor = connect(SMALL).execute(ORACLES[name])
    names, want = [d[0] for d in cursor.description], cursor.fetchall()
    got = QUERIES[name](spark, SMALL).select(*names).collect()
    assert want and sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_pipeline_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    for path in (odd_dir, empty_dir):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, path)
            assert docs.columns == columns
        kept = docs.select("doc_id", "text").collect()
        assert path == empty_dir or {r.doc_id for r in kept} == {3, None}  # one of the copies; a row without an id stays
        assert corpus_pipeline.run(spark, path).count() == len(kept)


def test_base_of_language_model(odd, odd_docs):
    tokens = [(i, spaced(lower(t)) + [None]) for i, t in odd_docs]
    counts = Counter(w for i, ws in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in odd["op1"]) == want
    assert all(r["score"] < 0 for r in odd["op1"])


def test_context_trees_against_plain_recursion():
    """All depths by dictionaries, on texts whose runs all were seen."""
    texts = ["abracadabra", "abrab", ""]
    counts = defaultdict(lambda: [0, 0])
    sequences = [[treeweight.BEFORE] * treeweight.DEPTH + list(t.encode()) + [treeweight.END] for t in texts]

    def decisions(symbol):
        for b in range(8):
            yield (1 << b) | (symbol >> (8 - b)), symbol >> (7 - b) & 1

    for s in sequences:
        for i in range(treeweight.DEPTH, len(s)):
            for node, bit in decisions(s[i]):
                for d in range(treeweight.DEPTH + 1):
                    counts[tuple(s[i - d:i]), node][bit] += 1
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) for t in texts)])
    keys, firsts = treeweight.runs(data, offsets)
    assert len(keys) == len(data) + len(texts) and firsts.tolist() == [0, 12, 18]
    distinct, n = np.unique(keys, return_counts=True)
    levels = treeweight.fold_levels(distinct, n)
    for d in (treeweight.DEPTH, treeweight.SPLIT):
        key, n0, n1 = levels[d][:3]
        got = {(tuple(int(k) >> 8 * (d - i) & 255 for i in range(d)), int(k) & 255): [a, b] for k, a, b in zip(key, n0, n1)}
        assert got == {k: v for k, v in counts.items() if len(k[0]) == d}
    assert treeweight.block_log(np.array([2.0]), np.array([1.0]))[0] == pytest.approx(math.log(0.5 * 0.75 / 6))


def test_probabilities_sum_to_one(spark, tmp_path):
    """After one context the probabilities of all symbols, seen or not, make one."""
    counted = [(int.from_bytes(bytes([254, 254, 97, 98, 99, s]), "big"), 3 if s in (97, 100) else 0) for s in range(256)]
    rows = treeweight.learn(spark.createDataFrame(counted, "key bigint, n bigint")).collect()
    assert len(rows) == 256 and sum(math.exp(r.value) for r in rows) == pytest.approx(1)
    assert {r.key & 255 for r in sorted(rows, key=lambda r: -r.value)[:2]} == {97, 100}


def test_texts_stream_past_their_answers(spark, monkeypatch):
    """No group gathers a block's texts, and scores do not depend on how blocks and batches are cut."""
    docs = spark.createDataFrame([(i, None if i % 9 == 0 else f"Text {i} of {i % 7} " + "many words " * (i % 30)) for i in range(200)],
                                 "doc_id bigint, text string").repartition(3)
    want = {tuple(r) for r in treeweight.score(docs).collect()}
    monkeypatch.setattr(treeweight, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(treeweight, "PACK", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        scored = treeweight.score(docs)
        got = {tuple(r) for r in scored.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 200 and {r[:5] for r in got} == {r[:5] for r in want}
    assert [r[5:] for r in sorted(got)] == [pytest.approx(r[5:]) for r in sorted(want)]
    # the one that is left has the shares of the trees
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInArrow") == 1


def test_license_places(odd, odd_docs):
    want = []
    for i, t in odd_docs:
        w = alnum(t)
        places = [(k, label) for phrase, label in licenses.BASE for k in range(len(w))
                  if w[k:k + len(phrase.split())] == phrase.split()]
        at = [p for p, _ in places]
        want.append((str(i), len(w), len(at), min(at, default=None), max(at, default=None),
                     ",".join(sorted({x for _, x in places}))))
    got = [(str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in odd["op2"]]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_license_suppression(spark):
    rules = licenses.rules()
    assert len(rules) > 300 and len({r[0] for r in rules}) == len(rules)
    text = "licensed under the gnu lesser general public license version 2 1 or the mit license"
    words = [k for k in licenses.KEYWORDS if k in text]
    df = spark.createDataFrame([("x", text, words), ("y", "mit license " * 40 + "mit license", ["mit"])],
                               "id string, words_text string, keywords array<string>")
    got = defaultdict(list)
    for r in licenses.detections(df).collect():
        got[r.id].append((r.label, r.priority, r.start, r.end))
    assert sorted(got["x"]) == [("lgpl", 2, 0, 11), ("mit", 4, 12, 15)]
    assert len(got["y"]) == 41


def test_license_names_alone(spark):
    """The bare name of each family is found in a text that holds nothing else."""
    want = {}
    for i, (label, _, name, _) in enumerate(licenses.FAMILIES):
        bare = re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", re.sub(r"\(\?:[^()]*\)\?", "", name)).split("|")[0]
        want[i] = (label, bare.replace("[sc]", "s").replace("?", ""))
        assert re.fullmatch(name, want[i][1])
    df = spark.createDataFrame([(i, t) for i, (_, t) in want.items()], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [want[i] for i in want if want[i][0] not in got[i].labels.split(",") or got[i].score < 0.6] == []


def test_ledger(spark):
    df = spark.createDataFrame([doc(1, "x " * 10), doc(2, " ".join(f"w{i}" for i in range(50))), doc(3, "a&& b&& " * 30)])
    df = df.toDF("doc_id", "text", "lang", "source", "n_chars")
    entries = quality.ledger(df)
    rows = {r.rule: r for r in quality.ablation(entries, ("clean", 1)).collect()}
    assert rows["few_words"].n_only_this == 0 and rows["symbol_share"].n_failed == 1
    assert rows["repeated_windows"].n_failed == 2 and rows["repeated_windows"].n_kept_without == 1
    assert {r.doc_id for r in quality.keep(df).collect()} == {2}


def test_toxic_words(spark, tmp_path):
    rng = np.random.default_rng(5)
    parts = ["ban", "lor", "mi", "tes", "ko", "ra", "del", "su"]
    docs, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(parts, 3)) for _ in range(40)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[int(rng.integers(40))] = str(rng.choice(["numpty", "wazzock"]))
        docs.append(doc(i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs += [doc(9001, "ban lor n u m p t y mites"), doc(9002, "suban numpxty lor"), doc(9003, "ban lor mites ko")]
    path = write_tables(spark, tmp_path, docs, labels=labels)
    rows = {r.doc_id: r for r in QUERIES["op4_string_kernel_svm"](spark, path).collect()}
    held = [i for i in range(600) if rows[i].held_out]
    assert len(held) > 80 and np.mean([rows[i].predicted == (i % 4 == 0) for i in held]) > 0.97
    assert [rows[i].predicted for i in (9001, 9002, 9003)] == [1, 1, 0]
    same = toxicity.kernel(["numpty", "numpxty", "bandel"], ["numpty"])[:, 0]
    assert same[0] == pytest.approx(1) and same[1] > 0.5 > same[2]


def test_warc(odd, spark, odd_dir):
    pages = [(r.page_id, r.html or "") for r in spark.read.parquet(f"{odd_dir}/pages.parquet").collect()]
    lead = defaultdict(list)
    for p, h in pages:
        lead[h].append(-2**63 if p is None else p)
    want = []
    for p, h in pages:
        top = max(lead[h])
        first = top == (-2**63 if p is None else p)
        want.append((str(p), len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                     "response" if first else "revisit", None if first else top))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in odd["op5"]) == sorted(want)
    order = sorted(odd["op5"], key=lambda r: (r["piece"], r["place"]))
    assert [(r["urlkey"], r["ts"]) for r in order] == sorted((r["urlkey"], r["ts"]) for r in order)


def test_loser_tree():
    rng = np.random.default_rng(3)
    for k in (1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.integers(0, 50, rng.integers(0, 20)).tolist()) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)
    assert list(warc.LoserTree([])) == []


def test_shards(odd, odd_docs):
    rows = odd["op6"]
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))


@pytest.mark.parametrize("copies", [0, 3000])
def test_shards_are_even(spark, copies):
    rng = np.random.default_rng(1)
    rows = [doc(i, "same text here" if i < copies else "x" * int(rng.integers(1, 400)) + str(i)) for i in range(4000)]
    got = sharding.placement(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert len(got) == 4000 and len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 900


def test_near_duplicates(spark):
    rng = np.random.default_rng(2)
    base = [f"t{i}" for i in range(120)]
    rows = [doc(i, " ".join(rng.choice(base, 120))) for i in range(40)]
    for i in range(40, 160):  # a large group of near copies of one text
        w = rows[7][1].split()
        w[int(rng.integers(120))] = f"new{i}"
        rows.append(doc(i, " ".join(w)))
    rows += [doc(500, rows[3][1].upper()), doc(501, "one two"), doc(502, "One  two"), doc(503, "one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    sets = {i: {tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))} for i, w in ((r[0], spaced(lower(r[1]))) for r in rows)}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: r for r in neardup.classes(df).collect()}
    assert {i: (len(sets[i]), find(i)) for i in sets} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_near_duplicates_in_large_families(spark):
    """Thousands of unlinked variants share each key; one pair of each family, in no key of its own, is alike."""
    rng, rows, pairs = np.random.default_rng(8), [], set()
    for family in range(3):
        template = [f"f{family}t{i}" for i in range(200)]
        for i in range(1000):
            # blocks of 16 words leave 0.83 at most; two of 5 words apart from each other leave 0.87
            size, at = (5, 40 + 60 * (i % 2)) if i in (500, 501) else (16, int(rng.integers(2, 180)))
            rows.append(doc(family * 1000 + i, " ".join(
                template[:at] + [f"f{family}n{i}x{k}" for k in range(size)] + template[at + size:])))
        pairs.add((family * 1000 + 501, family * 1000 + 500))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {(r.doc_id, r.component_id) for r in neardup.classes(df).where("NOT kept").collect()}
    assert got == pairs


def test_prefix_join_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    sets = [set(rng.choice(60, int(rng.integers(1, 40)), replace=False).tolist()) for _ in range(40)]
    for s in list(sets):
        for _ in range(4):
            sets.append((s - set(rng.choice(60, 2).tolist())) | set(rng.choice(60, int(rng.integers(0, 4))).tolist()) or {1})
    comp = [int(c) for c in rng.integers(0, 30, len(sets))]
    vertices = spark.createDataFrame([(i, len(s), c) for i, (s, c) in enumerate(zip(sets, comp))], "rep bigint, n bigint, comp bigint")
    table = spark.createDataFrame([(i, sorted(map(int, s))) for i, s in enumerate(sets)], "id bigint, set array<bigint>")
    for percent in (85, 60):
        want = {(a, b) for a in range(len(sets)) for b in range(a) if comp[a] != comp[b]
                and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
        got = {(max(r), min(r)) for r in neardup.settled(vertices, table, percent).collect()}
        assert len(want) > 100 and got == want


def test_chains_of_links(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300)]
    got = dict(neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert {got[i] for i in range(1, 61)} == {1} and got[300] == 100


def test_bpe(odd, odd_docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in odd_docs:
        ids = own.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in odd["op9"]) == sorted(want)


def test_every_character_splits_alike():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table, pieces = bpe.ranks_of(path), bpe.splitter(public_tokenizers.PATTERN)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for form in ("{}", "a{}1{}", " {}"):
        for at in range(0, len(every), 50_000):
            text = "".join(form.replace("{}", c) for c in every[at:at + 50_000])
            got = [i for ids in table.encode_pieces([p.encode() for p in pieces(text)]) for i in ids.tolist()]
            assert got == own.encode_ordinary(text), (form, at)


def test_more_rows_take_more_ranges(spark, monkeypatch):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('x', cast(id % 7 as int)) as text")
    monkeypatch.setattr(sharding, "LEAST_PARTS", 1)
    monkeypatch.setattr(sharding, "RANGE_ROWS", 20)
    rows = sharding.shards(docs, n_shards=4).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 400 and sorted(slots) == [0, 1, 2, 3]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [sum(r["size"] for r in rows if r.shard == k) for k in range(4)]
    assert max(sizes) - min(sizes) <= 0.1 * sum(sizes) / 4


def test_long_pieces():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    table = bpe.ranks_of(path)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(4)
    for piece in ("a" * 3000, "ab" * 700, "=" * 999, "".join(rng.choice(list("abcdefgh"), 2000)), "abcabd" * 200):
        assert table.encode_pieces([piece.encode()])[0].tolist() == own.encode_ordinary(piece)


def test_main_text():
    page = ('<html><head><title>T</title><script>var a="</p>";</script></head><body><header>Top</header><nav><a>Menu</a></nav>'
            '<div class="cookie-notice">We use cookies</div><article><h1>Title &amp; more</h1><p>First\n para <b>bold</b>x'
            '<p>Second<br>line<form><input>Sign</form><div id="comments">No</div></article><aside>Side</aside>'
            '<footer>&copy; us</footer></body></html>')
    assert html.main_texts([page]) == ["Title & more First para boldx Second line"]
    common = "shared words that stand on every single page of this host"
    pages = [f"<p>{common}</p><p>{w} is what this page alone says</p>" for w in ("one", "two", "three")]
    assert html.main_texts(pages) == [f"{w} is what this page alone says" for w in ("one", "two", "three")]
    copies = [f"<article><p>{common}</p></article>"] * 2
    assert html.main_texts(copies) == [common] * 2
    assert html.main_texts(["", "<", "a < b &lt; c", "<!-- x"]) == ["", "<", "a < b < c", ""]


def test_cover_chooses_among_several_articles(spark, monkeypatch):
    """A card of another article stands on several pages and goes; a page's own article stays whole, also as a copy."""
    monkeypatch.setattr(html, "SHARE", 40)
    def said(name, n):
        return " ".join(f"{name}{k}" for k in range(n))
    shared, once, long_ = said("card", 10), said("only", 10), said("copy", 40)
    own = [said(f"own{i}x", 20) for i in range(4)]
    rows = [f"<nav>menu</nav><article>{own[0]}</article><aside>x</aside><article><h2>{shared}</h2></article>",
            f"<article>{shared}</article><p>outside</p><article>{own[1]}</article>",
            f"<main><p>{own[2]} {said('copy', 8)}</p><article>{shared}<form>f</form></article><article>{once}</article></main>",
            # a copy that is longer than what its page alone says
            f"<main><h1>first title</h1><article>{long_}</article></main>",
            f"<main><h1>second title</h1><article>{long_}</article></main>",
            # one article, though it holds a card's text; an article inside an article is part of it
            f"<article>{shared}</article>", f"<article>{own[3]}<article>{shared}</article></article>",
            # all covered: none is the page's own, none goes
            f"<article>{shared}</article><article>{long_}</article>"]
    want = [own[0], own[1], f"{own[2]} {said('copy', 8)} {once}", f"first title {long_}", f"second title {long_}", shared,
            f"{own[3]} {shared}", f"{shared} {long_}"]
    assert html.main_texts(rows) == want
    pages = spark.createDataFrame([(i, "http://h.example/%d" % i, r) for i, r in enumerate(rows)]
                                  + [(99, "http://other.example/", rows[0])], "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == dict(enumerate(want)) | {99: f"{own[0]} {shared}"}  # the card stands on one page of that host


def test_hosts_are_searched_where_pages_have_an_article(spark, monkeypatch):
    """The check follows the search and does not replace it: a search that fails fails the extraction."""
    def broken(share):
        raise RuntimeError("searched")
    pages = spark.createDataFrame([(i, "http://h.example/", f"<nav>{'a menu of words ' * 4}{i}</nav><article>text {i}</article>")
                                   for i in range(3)], "page_id bigint, url string, html string")
    assert {r.text for r in html.extract(pages).collect()} == {"text 0", "text 1", "text 2"}
    monkeypatch.setattr(html, "share_runs", broken)
    # without broadcasts, as for large tables, Spark leaves out a side that an empty one makes needless
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Exception, match="searched"):
            html.extract(pages).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_articles_are_searched_and_the_bit_set_changes_nothing(spark, monkeypatch):
    """The tokens of a page's only article are searched, and cover decides about them; a fuller bit set lets more through."""
    def said(name, n):
        return " ".join(f"{name}{k}" for k in range(n))
    quoted, menu = said("quoted", 12), said("menu", 9)
    rows = [(i, "http://h.example/", f"<nav>{menu} {i}</nav><article>{said(f'own{i}x', 30)} {quoted} {i}</article>") for i in range(40)]
    rows += [(100 + i, "http://h.example/", f"<p>{quoted}</p><p>alone{i} here</p>") for i in range(2)]
    rows += [(200, "http://h.example/", rows[0][2]), (201, "http://other.example/", f"<p>{quoted} {menu}</p>"), (202, None, None)]
    want = {i: f"{said(f'own{i}x', 30)} {quoted} {i}" for i in range(40)} | {100: "alone0 here", 101: "alone1 here", 201: f"{quoted} {menu}", 202: ""}
    want[200] = want[0]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    for limits in ({}, {"ANCHORS": 50, "BITS": 8, "SHARE": 60}):
        for name, value in limits.items():
            monkeypatch.setattr(html, name, value)
        assert {r.page_id: r.text for r in html.extract(pages).collect()} == want
        assert {(r.text, r.n_pages) for r in html.repeats(pages).collect()} == {(quoted, 42), (menu, 40)}

    def broken(share):
        raise RuntimeError("searched")
    monkeypatch.setattr(html, "share_runs", broken)
    only = spark.createDataFrame([(i, "http://h.example/", f"<article>{quoted} {i}</article>") for i in range(2)],
                                 "page_id bigint, url string, html string")
    with pytest.raises(Exception, match="searched"):
        html.extract(only).collect()


def test_runs_are_counted_over_the_whole_host(spark):
    """Each passage stands on two of 2,400 pages of a host; copies of a page do not empty each other."""
    own = [f"alone on page{i}" for i in range(2400)]
    rows = [(i, "http://big.example/%d" % i, f"<p>{own[i]}</p><p>" + " ".join(f"p{i % 1200}w{k}" for k in range(9)) + "</p>")
            for i in range(2400)]
    same = "words of one page that was taken two times over"
    rows += [(i, "http://twice.example/", f"<p>{same}</p>") for i in (9001, 9002)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == dict(enumerate(own)) | {9001: same, 9002: same}


def test_many_small_pages_in_a_share(spark):
    """More pages than different words, and many equal ones: page ends are no words."""
    for texts in ([f"w{i % 3}" for i in range(31)], ["same short page"] * 500, ["x"] * 40):
        rows = [(i, "http://h.example/", f"<p>{t}</p>") for i, t in enumerate(texts)]
        got = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
        assert {r.page_id: r.text for r in got} == dict(enumerate(texts))


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 50, 200):
        tokens = np.concatenate([rng.integers(0, 3, n), np.full(20, 1)])
        order, ranks = html.suffix_array(tokens)
        suffixes = [tokens[i:].tolist() for i in range(len(tokens))]
        assert order.tolist() == sorted(range(len(tokens)), key=lambda i: suffixes[i])
        got = html.common_prefixes(order, ranks).tolist()
        assert got == [0] + [next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
                             for a, b in zip((suffixes[i] for i in order), (suffixes[i] for i in order[1:]))]


def test_extract_against_plain_search(spark, monkeypatch):
    """Whole extraction of pages without articles against counting all runs of each host by dictionaries."""
    monkeypatch.setattr(html, "SHARE", 200)
    rng = np.random.default_rng(6)
    passages = [[f"p{k}w{i}" for i in range(int(rng.integers(6, 20)))] for k in range(12)]
    rows, parsed = [], []
    for i in range(120):
        host = f"host{int(rng.integers(0, 4))}.example"
        parts = [passages[int(k)] if rng.random() < 0.5 else [f"u{i}x{j}y{k}" for j in range(int(rng.integers(3, 15)))]
                 for k in rng.integers(0, 12, 4)]
        nav = rng.random() < 0.7
        article = i % 7 == 0
        page = "".join(f"<p>{' '.join(p)}</p>" for p in parts)
        page = (f"<nav>{' '.join(passages[0])}</nav>" if nav else "") + (f"<article>{page}</article><p>after it</p>" if article else page)
        rows.append((i, f"http://{host}/{i}", page))
        parsed.append((host, html.blocks(page)))
    rows += [(1000 + i, *rows[i][1:]) for i in range(5)]  # copies do not count as other pages
    where = defaultdict(set)
    for host, some in parsed:
        for stream in html.streams(some):
            for k in range(len(stream) - 7):
                where[host, tuple(stream[k:k + 8])].add(html.page_hash(some))
    want = {}
    for (i, _, _), (host, some) in zip(rows, parsed):
        if any(z == "main" for _, z in some):
            want[i] = " ".join(t for t, z in some if z == "main")
            continue
        tokens = [(w, z) for t, z in some for w in t.split(" ")]
        again = [False] * len(tokens)
        for k in range(len(tokens) - 7):
            if len(where[host, tuple(w for w, _ in tokens[k:k + 8])]) > 1:
                again[k:k + 8] = [True] * 8
        want[i] = " ".join(w for (w, z), c in zip(tokens, again) if z == "open" and not c)
    want |= {1000 + i: want[i] for i in range(5)}
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == want and sum(want[i] != " ".join(t for t, z in parsed[i][1] if z == "open") for i in range(120)) > 30
    # the long substrings of each host, and on how many pages they stand
    long_ = html.repeats(pages).collect()
    assert long_ and all(r.n_tokens >= 8 and r.n_pages >= 1 for r in long_)
    assert {" ".join(passages[0])} & {r.text for r in long_} or len(passages[0]) < 8


def test_deep_nesting_is_linear():
    deep = "<div><span>" * 20_000 + "x" + "</span></div>" * 20_000 + "</i>" * 20_000
    start = time.perf_counter()
    assert html.blocks(deep) == [("x", "open")] and time.perf_counter() - start < 5


def test_near_duplicates_of_five_words(spark):
    """The pipeline's width and threshold against all pairs."""
    rng = np.random.default_rng(12)
    rows = []
    for family in range(12):
        base = [f"f{family}w{k}" for k in rng.integers(0, 300, 150)]
        for i in range(8):
            w = list(base)
            for k in rng.integers(0, 150, int(rng.integers(0, 7))):
                w[k] = f"e{family}x{i}x{k}"
            rows.append(doc(family * 10 + i, " ".join(w)))
    rows += [doc(900, "a b c d"), doc(901, "A b  c d"), doc(902, "a b c"), doc(903, "")]
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in ((r[0], spaced(lower(r[1]))) for r in rows)}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in neardup.classes(df, percent=80, words=5).collect()}
    assert {i: (len(sets[i]), find(i)) for i in sets} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}
