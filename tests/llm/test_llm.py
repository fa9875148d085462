"""The ten operators and the pipeline against brute force, round trips, held-out rows and edge cases."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.llm import htmltext, langid, licenses, linededup, merkle, minhash, packing, piece_bpe, queries, toxicity, vamana
from tests.conftest import SF_SMALL

LONG = "the quick brown fox jumps over the lazy dog again and again "
ODD = [  # null id and text, empty and white-space texts, a long text, repeated rows, ties
    (None, None), (1, None), (2, ""), (3, " \t\n "), (4, LONG * 3000), (5, LONG), (5, LONG), (6, LONG.upper()),
    (7, "ñandú çedilla ÆØ 漢字 👍🏽 MIT License"), (8, "a"), (None, LONG), (9, "x\n\ny\n"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with columns whose names clash with those the operators add."""
    schema = "doc_id long, text string, score string, n_lines int, row int, lang string"
    return spark.createDataFrame([(i, t, "s", 1, 2, None) for i, t in ODD], schema)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def model_file():
    return queries.tokenizer_file("piece_bpe_32k.model")


# ---- 1 licenses ---------------------------------------------------------------------------------

def test_licenses_against_scan_by_hand(spark, odd, none):
    rows = [(1, "MIT license, mit-LICENSE mit  license"), (2, "the GNU general public license"), (3, "mit x license"), (4, None), (5, ""),
            (6, "permission is hereby granted free of charge to any NEW person obtaining a copy of this software")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["first_word"], got[1]["last_word"]) == (6, 3, 0, 4)
    assert got[2]["base_labels"] == "gpl" and got[2]["first_word"] == 2
    assert got[3]["n_base"] == 0 and got[3]["first_word"] is None and got[3]["labels"] == ""
    assert got[4]["n_words"] == 0 and got[5]["score"] == 0.0
    assert got[6]["labels"] == "mit" and got[6]["base_labels"] == "" and 0.6 <= got[6]["score"] < 1  # a word put in
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(none).count() == 0


# ---- 2 near-duplicates --------------------------------------------------------------------------

def brute_components(rows, k, percent):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                part[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc if doc is not None else -1, len(sets[i]), least.get(find(i), -1)) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_all_pairs(spark, docs, odd, none, k):
    rng = np.random.default_rng(k)
    words = [f"w{i}" for i in range(3000)]
    base = list(rng.choice(words, 120))
    made = []
    for i in range(120):  # one large group of near copies whose pairs lie on both sides of the threshold
        copy = list(base)
        for _ in range(rng.integers(0, 14 if k == 2 else 6)):
            copy[rng.integers(len(copy))] = str(rng.choice(words))
        made.append((10_000 + i, " ".join(copy)))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] + made + ODD[:4] + ODD[5:]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = frame._jdf and spark.sparkContext.getCheckpointDir() + f"/near-{k}"  # a stored table, as the operator asks for
    frame.write.mode("overwrite").parquet(path)
    got = minhash.near_duplicates(spark.read.parquet(path), k, 80).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"])
                  for r in got) == brute_components(rows, k, 80)
    assert minhash.near_duplicates(none, k, 80).count() == 0


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for share in (0.3, 0.8, 0.95):
        cut = int(2000 * 2 * share / (1 + share))
        a, b = np.unique(x[:2000]), np.unique(np.concatenate([x[:cut], rng.integers(0, 2**63, 2000 - cut, dtype=np.uint64)]))
        r = minhash.sketches([a, b, np.union1d(a, b)])
        assert (np.maximum(r[0], r[1]) == r[2]).all()
        assert abs(minhash.estimate(r[:1], r[1:2], np.array([len(a)]), np.array([len(b)]))[0] - share) < 0.17


def test_rows_keep_their_number_when_splits_change(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    words = [f"w{i}" for i in range(2000)]
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(words, 60)) for _ in range(60)]
    rows = [(i, texts[i % 60] + (" end" if i >= 60 else "")) for i in range(120)]
    for i in range(6):  # files of different sizes, which Spark deals out by size
        part = rows[i * (i + 1) * 3:(i + 1) * (i + 2) * 3] if i < 5 else rows[90:]
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    splits = itertools.cycle(["4k", "128m"])
    plain = minhash._texts_of

    def texts_of(ids, rows):
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(splits))
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        return plain(ids, rows)

    monkeypatch.setattr(minhash, "_texts_of", texts_of)
    try:
        source = spark.read.parquet(str(tmp_path / "docs"))
        got = minhash.near_duplicates(source, 2, 80).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == \
            sorted((i, 59 + (i >= 60), i % 60, i < 60) for i in range(120))
        left = corpus_pipeline.near_dedup(spark, source, SF_SMALL)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        assert sorted(int(zlib.crc32(r["text"].removesuffix(" end").encode())) for r in left.collect()) == \
            sorted(zlib.crc32(t.encode()) for t in texts)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_text_filter_holds_every_place(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FILTER_BITS", 1 << 16)
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 16))
    ids = spark.range(1 << 20).where(place.isin(0, 1, 32767, 32768, 65535))
    assert {r[0] for r in ids.select(place).distinct().collect()} == {0, 1, 32767, 32768, 65535}
    got = minhash._texts_of(ids, spark.range(1 << 17).withColumn("text", F.col("id").cast("string"))).collect()
    assert {r["id"] for r in got} == {r["id"] for r in ids.where(F.col("id") < 1 << 17).collect()}
    assert all(r["text"] == str(r["id"]) for r in got)


# ---- 3 language ---------------------------------------------------------------------------------

def test_language_held_out_and_spans(spark, docs, odd, none):
    out = queries.op3_language_id(spark, SF_SMALL).join(docs.select("doc_id", "lang"), "doc_id")
    right, all_ = out.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * all_
    model = langid.fit(docs)
    en = "the of and that was with from only things are "
    de = "der die und nicht eine schaft auch mit von "
    got = langid.predict(spark.createDataFrame([(1, en * 4 + de * 9), (2, "12 34"), (3, None)], "doc_id long, text string"), model).collect()
    assert got[0]["lang_pred"] == "de" and [s["lang"] for s in got[0]["spans"]] == ["en", "de"]
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["spans"] == []
    assert langid.predict(odd, model).count() == len(ODD) and langid.predict(none, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(odd)).collect()} == {"und"}


def test_viterbi_against_plain_recursion():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 64, 65, 200, 0]
    ptr = np.concatenate([[0], np.cumsum(sizes)])
    score = rng.normal(size=(ptr[-1], 3)) * 6
    got = langid.viterbi(score, ptr, 5.0)

    def value(path, s):
        return sum(s[i, p] for i, p in enumerate(path)) - 5.0 * sum(a != b for a, b in zip(path, path[1:]))

    for d, n in enumerate(sizes):
        s = score[ptr[d]:ptr[d + 1]]
        v = np.zeros(3)
        for row in s:
            v = row + np.maximum(v, v.max() - 5.0)
        if n:
            assert value(got[ptr[d]:ptr[d + 1]], s) == pytest.approx(v.max())


# ---- 4 pieces -----------------------------------------------------------------------------------

def test_pieces_equal_the_library(spark, docs, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file())
    m = piece_bpe.model(model_file())
    rng = np.random.default_rng(2)
    signs = list("ab the of▁  \t\n漢ñé👍(=-_") + ["ing", "tion", " "]
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(3000)] + [t or "" for _, t in ODD]
    assert [m.encode(t) for t in texts] == sp.encode(texts)
    assert [m.decode(i) for i in sp.encode(texts)] == [sp.decode(i) for i in sp.encode(texts)]
    loose = [rng.integers(3, 400, 6).tolist() for _ in range(500)]  # bytes that are no UTF-8
    assert [m.decode(i) for i in loose] == [sp.decode(i) for i in loose]
    got = piece_bpe.encode_decode(odd, model_file()).collect()
    assert [r["ids"] for r in got] == sp.encode([t or "" for _, t in ODD])
    assert piece_bpe.encode_decode(none, model_file()).count() == 0
    for left, right in itertools.product(list(m.id)[300:360], repeat=2):
        assert m.agree(m.id[left], m.id[right]) == (m.merge(list(left + right)) == [left, right])


# ---- 5 vectors ----------------------------------------------------------------------------------

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16))
    x[50:150] = x[0] + rng.normal(size=(100, 16)) * 0.12
    x[150:160] = x[1]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, []), (905, [1.0, 2.0]), (905, [2.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vamana.near_vectors(frame).collect() if r["vec_id"] != 905}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = (u @ u.T >= 0.9).sum(1) - 1
    found = np.array([got[i]["n_links"] for i in range(300)])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()
    assert {got[i]["component_id"] for i in range(150, 160)} == {1} and got[1]["kept"] and not got[150]["kept"]
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904))
    assert [r["n_links"] for r in vamana.near_vectors(frame.where("vec_id = 905")).collect()] == [1, 1]
    assert vamana.near_vectors(frame.limit(0)).count() == 0
    hit, all_ = vamana.audit(frame.where("vec_id < 300"), vamana.near_vectors(frame.where("vec_id < 300")), every=7)
    assert all_ > 0 and hit >= 0.9 * all_


def test_search_in_blocks_finds_links_across_them(spark, monkeypatch):
    monkeypatch.setattr(vamana, "BLOCK", 64)
    rng = np.random.default_rng(4)
    x = rng.normal(size=16) + rng.normal(size=(200, 16)) * 0.05  # one group, several base blocks
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert {(r["n_links"], r["component_id"]) for r in vamana.near_vectors(frame).collect()} == {(199, 0)}


# ---- 6 pages ------------------------------------------------------------------------------------

@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<body></body>", ""), ("<div></p></div></x>y", "y"),
    ("<nav>menu</nav><article><h1>T &amp; t</h1><p>One\n two <b>three</b>.<br>four</p><aside>x</aside><ul><li>i<li>j</ul></article><footer>f</footer>",
     "T & t\nOne two three. four\ni\nj"),
    ("<body><div class='cookie-notice'>accept</div><div id=main><p>" + "word " * 40 + "</p><p>" + "more " * 40 + "</p></div>"
     "<section class=comments><p>" + "remark " * 90 + "</p></section><form><p>name</p></form></body>",
     ("word " * 40).strip() + "\n" + ("more " * 40).strip()),
    ("<article><script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p title='a>b'>yes</p></article>", "yes"),
])
def test_main_text(page, text):
    assert htmltext.content(page) == text


@pytest.mark.parametrize("wrapper", ["class='content no-sidebar'", "class=layout-sidebar-right", "class='has-header'", "class=page-with-ads",
                                     "id=main-header-wrap", "class='page sidebar'", "class=widget", "id='footer'", "role=dialog"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrapper_names_leave_the_article(wrapper, tag):
    text = "<h1>Title</h1><p>" + "word " * 60 + "</p><div class=key-message><p>" + "key " * 40 + "</p></div><p class=privacy-law>" + "law " * 40 + "</p>"
    page = f"<body><div class=site-header><a href=/>Home</a></div><div {wrapper}><{tag}>{text}</{tag}><div class=share-buttons><p>Tell others</p></div>" \
           "<div class=comments><p>" + "remark " * 20 + "</p></div></div><div class=cookie-notice><p>" + "accept " * 20 + "</p></div></body>"
    assert htmltext.content(page) == "\n".join(["Title", ("word " * 60).strip(), ("key " * 40).strip(), ("law " * 40).strip()])


def test_names_that_still_cut():
    long = "<p>" + "remark " * 300 + "</p>"
    for away in (f"<section id=comments>{long}</section>", f"<div id=comments><article class=comment-body>{long}</article></div>",
                 f"<div class=cookie-bar>{long}</div>", "<div class=related-posts><article><p>Teaser</p></article></div>"):
        for tag in ("article", "div"):
            page = f"<body><{tag}><p>{'word ' * 40}</p><p>{'more ' * 40}</p></{tag}>{away}</body>"
            if tag == "article" or "Teaser" not in away:
                assert htmltext.content(page) == ("word " * 40).strip() + "\n" + ("more " * 40).strip()
    assert htmltext.content("<body><div class=notice><p>Short</p></div></body>") == "Short"
    assert htmltext.content("<body><div class=cookie-notice><p>accept</p></div></body>") == ""
    assert htmltext.content("<div class=sidebar>" * 300 + "deep") == "deep"


def test_pages_against_cut_article(spark):
    import html

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"<[^>]+>", re.sub(r"</?b>|<br>", " ", inner))]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], "page_id long, url string, html string")
    assert [r["text"] for r in htmltext.extract(odd).collect()] == ["", "", ""] and htmltext.extract(odd.limit(0)).count() == 0


# ---- 7 fingerprints -----------------------------------------------------------------------------

def test_fingerprints_edit_and_order(spark, odd, none):
    rows = [(i, f"Alpha {i}. Beta {i}! Gamma\nDelta {i % 3}. Same end.\nlast {i}") for i in range(40)]
    got = {r["doc_id"]: r for r in merkle.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for i, text in rows:
        follow, half = rows[(i - 1) % 40][1], len(text) // 2
        assert got[i]["edited"] == text[:len(text) - half] + follow[:half]
        assert got[i]["near_edited"] > got[i]["near_next"]
    same = merkle.fingerprints(spark.createDataFrame([(1, "a. b"), (2, "a. b"), (3, "a.  b")], "doc_id long, text string")).collect()
    marks = {r["doc_id"]: r["fingerprint"] for r in same}
    assert marks[1] == marks[2] != marks[3]
    out = merkle.fingerprints(odd).collect()
    assert len(out) == len(ODD) and merkle.fingerprints(none).count() == 0
    assert len({r["fingerprint"] for r in out if r["text"] == LONG}) == 1
    pair = spark.createDataFrame([(got[3]["fingerprint"], got[3]["edited_fingerprint"])], "a string, b string")
    assert pair.select(merkle.differing_paragraphs(F.col("a"), F.col("b"))).first()[0][-1] == 2


# ---- 8 packing ----------------------------------------------------------------------------------

def test_packing_whole_and_without_padding(spark, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    frame = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] or "" for r in frame.collect()}
    rows = packing.pack(frame, queries.tokenizer_file("byte_bpe_50k.json")).collect()
    for doc, text in texts.items():
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in own) == ids.tobytes() and {r["doc_tokens"] for r in own} == {len(ids)}
    places = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert places.get(r["sequence_id"], 0) == r["offset"]
        places[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in places.values())
    assert packing.pack(odd, queries.tokenizer_file("byte_bpe_50k.json")).count() >= len(ODD)
    assert packing.pack(none, queries.tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_fast_ids_equal_the_library():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json")), packing.encoder(queries.tokenizer_file("byte_bpe_50k.json"))
    rng = np.random.default_rng(5)
    signs = list("abc '0 9\t\n\r\x85​漢éñ👍🏽½٣") + ["'ll", "  ", "<|endoftext|>"]
    for _ in range(1500):
        s = "".join(rng.choice(signs, rng.integers(0, 30)))
        assert e(s).tolist() == t.encode(s, add_special_tokens=False).ids


# ---- 9 toxicity ---------------------------------------------------------------------------------

def test_toxicity_learns_folds_and_excepts(spark, odd, none):
    rng = np.random.default_rng(6)
    words = [f"wort{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(words, 60))
        bad = i % 3 == 0
        if bad:
            w[5], w[9] = "grumbold" + str(rng.choice(["", "s", "ery"])), "Grumbold"
        elif i % 30 == 1:  # rare enough among the clean texts for the word to be learned
            w[5:7] = ["grumbold", "harbour"]  # the phrase is clean
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(frame, marks)
    assert any("grumboid".startswith(s) or s.startswith("grumboid") for s in lexicon.weight)  # l folds to i
    clean = " ".join(words[:30])
    tests = [(1, f"{clean} grumbold {clean} grumbold"), (2, f"{clean} GrumbО1d gгumbold"), (3, clean), (4, f"{clean} grumbold harbour"), (5, None), (6, "")]
    got = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), lexicon).collect()}
    assert [got[i]["predicted"] for i in (1, 3, 4, 5, 6)] == [1, 0, 0, 0, 0]
    assert got[2]["score"] > 0 and got[5]["score"] == got[6]["score"] == 0.0
    assert toxicity.score(odd, lexicon).count() == len(ODD) and toxicity.score(none, lexicon).count() == 0
    assert {r["_score"] for r in toxicity.score(odd, toxicity.fit(odd, marks.limit(0))).collect()} == {0.0}


# ---- 10 lines -----------------------------------------------------------------------------------

def brute_lines(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = {}
    for doc, text in rows:
        for line in (text or "").split("\n") if doc is not None else []:
            docs.setdefault(line.strip(" \t\n\x0b\x0c\r").translate(low), set()).add(doc)
    shared = {k: max(v) for k, v in docs.items() if len(k) >= 40 and len(v) >= 5}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if doc is None or shared.get(x.strip(" \t\n\x0b\x0c\r").translate(low), doc) == doc]
        out.append((-1 if doc is None else doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def test_lines_against_brute_force(spark, odd, none, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 7)  # several shards
    rng = np.random.default_rng(7)
    pool = [f"{'  ' if i % 2 else ''}Line {i} {'é' * 20} with enough characters to count {i}" for i in range(60)] + ["short", ""]
    rows = [(int(i), "\n".join(rng.choice(pool, rng.integers(0, 8)))) for i in range(80)] + ODD
    frame = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_lines int")
    got = linededup.dedup_lines(frame)
    assert got.columns == ["doc_id", "text", "n_lines", "_n_lines", "n_dropped"]
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["_n_lines"], r["n_dropped"], r["text"]) for r in got.collect()) == brute_lines(rows)
    assert linededup.dedup_lines(none).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(8).integers(0, 2**63, 5000, dtype=np.uint64))
    h = linededup.PerfectHash.build(keys)
    assert sorted(h.slots(keys)) == list(range(len(keys)))


# ---- pipeline and entry -------------------------------------------------------------------------

def test_pipeline_against_its_parts(spark, docs):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["language_id", "toxicity", "line_dedup", "near_dedup", "packing"]
    now = docs
    path = spark.sparkContext.getCheckpointDir()
    for i, (name, stage) in enumerate(P.STAGES[:-1]):
        before = [tuple(r) for r in now.select("doc_id", "text").collect()]
        out = stage(spark, now, SF_SMALL)
        assert out.columns == docs.columns
        out.write.mode("overwrite").parquet(f"{path}/pipe-{i}")
        now = spark.read.parquet(f"{path}/pipe-{i}")
        kept = [tuple(r) for r in now.select("doc_id", "text").collect()]
        if name == "language_id":
            assert sorted(kept) == sorted(x for x in before if any(c.isalpha() for c in x[1]))
        elif name == "line_dedup":
            assert sorted(kept) == sorted((d, t) for d, _, _, t in brute_lines(before))
        elif name == "near_dedup":
            groups = {}
            for doc, _, component in brute_components(before, 5, 80):
                groups.setdefault(component, set()).add(doc)
            assert sorted(len(g & {d for d, _ in kept}) for g in groups.values()) == [1] * len(groups)
    rows = P.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in rows} == {d for d, _ in kept}


def test_entry_holds_a_query_per_operator():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES) and names[-1] == "pipeline"
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)


def test_digest_columns(spark):
    row = queries.op4_piece_bpe(spark, SF_SMALL).where("doc_id = 0").first()
    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id = 0").first()["text"]
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    piece = queries.op8_packing(spark, SF_SMALL).where("doc_id = 0 and start = 0").first()
    ids = packing.encoder(queries.tokenizer_file("byte_bpe_50k.json"))(text)[:piece["length"]]
    assert piece["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
