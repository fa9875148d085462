"""Vector codes, phrase collocations and quality rules against brute force and edge cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.llm import collocations, pivotcodes, quality, queries
from critiq.llm.queries import id_remainder
from tests.conftest import SF_SMALL

# ---- vector codes -------------------------------------------------------------------------------


def plain_codes(rows, rounds=6, entries=16, parts=8):
    """rows of (vec_id, vector, label), all of one dimension: by full searches in Python's integers."""
    rows = sorted((r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(4096 * v) for v in r[1]] for r in rows]
    size = -(-len(whole[0]) // parts)
    whole = [w + [0] * (size * parts - len(w)) for w in whole]
    cut = [[tuple(w[p * size:(p + 1) * size]) for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [tuple(sum(v) // len(groups[i]) for v in zip(*groups[i])) if i in groups else e for i, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, total = [], Counter()
    for r, c in zip(rows, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), r[2]))
        total[r[2]] += out[-1][2]
    return sorted(((v, c, e, total[label], digest) for v, c, e, label in out), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, code string, away int"


@pytest.mark.parametrize("case", ["normal", "copies", "few", "wide", "ragged"])
def test_codes_against_full_search(spark, case):
    rng = np.random.default_rng(5)
    dim = 20 if case == "ragged" else 16
    scale = 3e4 if case == "wide" else 1.0  # beyond 64-bit squares
    n = 9 if case == "few" else 150
    vectors = (rng.normal(size=(n, dim)) * scale).tolist()
    if case == "copies":  # equal entries among the first, ties, entries that stay unused
        vectors = [vectors[i % 7] for i in range(n)]
    rows = [(i // 2 if case == "copies" else i, v, None if i % 5 == 0 else i % 3) for i, v in enumerate(vectors)]
    rows += [(None, vectors[0], 1), (1000, None, 2), (1001, [0.0] * (dim - 1) + [float("nan")], 2), (1002, [float("inf")] * dim, 2),
             (1003, [None] + [0.0] * (dim - 1), 2)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], VECTORS).repartition(3)
    assert rows_of(pivotcodes.compress(frame)) == plain_codes(rows)


def test_codes_edge_cases(spark):
    assert pivotcodes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert pivotcodes.compress(spark.createDataFrame([(1, None, 1, "x", 1)], VECTORS)).count() == 0
    rows = [(1, [1.0] * 8, 1, "x", 1), (1, [1.0] * 8, 1, "x", 1), (2, [1.0, 2.0], None, "x", 1), (3, [], None, "x", 1)]
    got = {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in pivotcodes.compress(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == {(1, "00" * 8, 0, 0), (2, None, None, None), (3, None, None, None)}
    only = pivotcodes.compress(spark.createDataFrame([(3, [], None, "x", 1)], VECTORS)).collect()
    assert [(r["code"], r["error"]) for r in only] == [("00" * 8, 0)]


def test_many_labels_are_joined_in_salts(spark, monkeypatch):
    rows = [(i, [float(i)] * 8, None if i % 3 == 0 else i % 7, "x", 1) for i in range(60)]
    frame = spark.createDataFrame(rows, VECTORS)
    wanted = rows_of(pivotcodes.compress(frame))
    monkeypatch.setattr(pivotcodes, "MAX_LABELS", 1)
    assert rows_of(pivotcodes.compress(frame)) == wanted == plain_codes([r[:3] for r in rows])


def test_pivots_leave_out_searches(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(16, 64)) * 5
    x = pivotcodes.integers(centres[rng.integers(0, 16, 2000)] + rng.normal(size=(2000, 64)) * 0.1)
    entries = pivotcodes.integers(centres).transpose(1, 0, 2)
    pivots = pivotcodes.choose_pivots(entries)
    _, _, evaluated = pivotcodes.Codebooks(entries, pivots).assign(x, pivotcodes.pivot_distances(x, pivots))
    assert evaluated < 0.25 * 2000 * 8 * 16


# ---- collocations -------------------------------------------------------------------------------


def plain_collocations(rows, least, top):
    count, words = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, 5):
                count.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    found = {k: a for k, a in count.items() if len(k[1]) >= 2 and a >= least}
    around = Counter()
    for (lang, w), a in found.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    around[lang, w[i:j]] = max(around[lang, w[i:j]], a)
    kept = defaultdict(list)
    for (lang, w), a in found.items():
        if 100 * around[lang, w] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (count[lang, w[:k]] + count[lang, w[k:]]), k) for k in range(1, len(w)))
        kept[lang].append((-score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, words[lang], -s)
                  for lang, own in kept.items() for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1))


COLLOCATION = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("shards", [1, 3, 4])
def test_collocations_against_plain_counts(spark, shards, monkeypatch):
    rng = np.random.default_rng(shards)
    words = [f"w{i}" for i in range(12)] + ["é", "a b", "漢字", "\x1c", " "]
    rows = [(str(rng.choice(["en", "de"])), " ".join(rng.choice(words, rng.integers(0, 40))) + str(rng.choice([".", "\n", "!x", ""])))
            for _ in range(200)]
    rows += [(None, "Mit lizenz, mit LIZENZ") for _ in range(8)] + [("und", "mit lizenz")] + [("en", None), (None, ""), ("en", "a a a a a a " * 30)]
    frame = spark.createDataFrame([(lang, text, "x", 1) for lang, text in rows], "lang string, text string, phrase string, n int").repartition(5)
    monkeypatch.setattr(collocations, "BUCKETS", 1 << 15)
    got = sorted(tuple(r[c] for c in COLLOCATION) for r in collocations.collocations(frame, 8, 100, shards).collect())
    assert got == plain_collocations(rows, 8, 100) and len(got) > 50


def test_activation_table_that_is_full_changes_nothing(spark, monkeypatch):
    rows = [("en", " ".join(f"w{(i * j) % 9}" for j in range(30))) for i in range(60)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "BUCKETS", 1)  # all phrases share one bucket
    got = sorted(tuple(r[c] for c in COLLOCATION) for r in collocations.collocations(frame, 5, 2000, 2).collect())
    assert got == plain_collocations(rows, 5, 2000)


def test_longer_phrases_wait_for_their_parts():
    ids = np.array([1, 2, 3, 0, 1, 2, 3, 0])
    hashes = np.array([[0, 0], [11 << 40, 1], [22 << 40, 2], [33 << 40, 3]], np.uint64)
    reached = np.full(collocations.BUCKETS, collocations.NEVER, np.uint8)
    at = (hashes[:, 0] >> np.uint64(20)).astype(int) & (collocations.BUCKETS - 1)
    assert list(collocations.active_phrases(ids, hashes, reached, 0, 4)) == []
    reached[at[1]], reached[at[2]] = 0, 2  # "1 2" may start at step 3
    assert list(collocations.active_phrases(ids, hashes, reached, 2, 4)) == []
    for step in (3, 6):
        found = {s: (begin.tolist(), n.tolist()) for s, _, begin, _, n in collocations.active_phrases(ids, hashes, reached, step, 4)}
        assert found == {2: ([3], [2])}
    assert list(collocations.active_phrases(ids, hashes, reached, 7, 4)) == []  # after its cycle


def test_word_numbers_and_blocks():
    words, ids = collocations.word_numbers("A b, c\tb!! \x1c Aé\n".encode())
    assert [words[i - 1].decode() if i else "." for i in ids] == ["a", "b", ".", "c", "b", ".", "\x1c", "aé", "."]
    assert collocations.word_numbers(b" ., ") [0] == [] and len(collocations.word_numbers(b"")[1]) == 0
    text = b"one two. three four, " * 50 + b"five " * 30
    cut = list(collocations._cut(text, 64))
    assert b"".join(cut) == text and len(cut) > 5 and all(c.rstrip().endswith((b".", b",")) for c in cut[:-1])


def test_collocations_long_text_and_empty(spark):
    schema = "lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], schema)).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "only once"), (None, None)], schema)).count() == 0
    text = "new york city is a place. " * 60_000  # cut into many blocks
    shared = type("Shared", (), {"value": np.zeros(collocations.BUCKETS, np.uint8)})()
    frame = spark.createDataFrame([("en", text)], schema)
    wanted = {**{p: 60_000 for p in ("new york city is", "york city is a", "city is a place", "place", "new york", "a place", "new", "york", "city",
                                     "is", "a", "york city", "city is", "is a", "new york city", "york city is", "city is a", "is a place")}, "": 360_000}
    for size in (0, 1, 2):  # nothing is lost to compaction where all is frequent
        rows = collocations.compact(frame.withColumn("shard", F.lit(1)), shared, size).select("lang", "text") if size else frame
        counts = collocations.scan(rows, shared, 1, 2, block=100_000).groupBy("high", "low").agg(F.sum("n").alias("n"))
        names = collocations.spell(rows, shared, block=100_000).groupBy("high", "low").agg(F.min("phrase").alias("phrase"))
        assert {r["phrase"]: r["n"] for r in counts.join(names, ["high", "low"], "left").collect()} == wanted


def test_compaction_keeps_what_matters(spark):
    block = collocations.Block({"en": [b"a b x a b c. y a b", b"c a b"], "de": [b"a b"]})
    reached = np.full(collocations.BUCKETS, collocations.NEVER, np.uint8)
    for i, (w, lang) in enumerate(zip(block.words, block.langs)):
        if w in (b"a", b"b", b"c") and lang == "en":
            reached[int(block.hashes[i][0] >> np.uint64(20)) & (collocations.BUCKETS - 1)] = 0
    shared = type("Shared", (), {"value": reached})()
    rows = [("en", "a b x a b c. y a b", 0), ("de", "a b", 0), ("en", "c a b", 1)]
    frame = spark.createDataFrame(rows, "lang string, text string, shard int").coalesce(1)
    got = {(r["lang"], r["shard"]): r["text"] for r in collocations.compact(frame, shared, 1).collect()}
    assert got[("en", 0)].split() == "a b . a b c . a b .".split() and got[("en", 1)].split() == "c a b .".split()
    assert got[("de", 0)] in ("", ".")


# ---- quality rules ------------------------------------------------------------------------------

ODD = [None, "", " \n\t ", "one", "a b c a b c", "x y\nx y\n x y\n\n\nx y", "# $ | <b>", "ünï 漢字 é", "same " * 80_000 + "end",
       "\x1c\x85 z", "p q r s\np q r s t"]


def plain_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside)


def test_counts_against_plain(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text")
    for text in [*ODD, *(r["text"] for r in docs.collect())]:
        assert quality.count_text(text)[:5] == plain_counts(text)


def test_word_numbers_in_pieces():
    text = ("alpha beta  gamma\n" * 50 + "x" * 40 + " alpha").encode()
    whole, cut = quality.word_numbers(text), quality.word_numbers(text, piece=7)
    assert (whole == cut).all() and len(whole) == 152
    big = np.arange(2 << 20)
    assert quality.repeated_words(np.concatenate([big, big[:5]])) == 10  # more distinct words than one key holds


def test_lists_are_learned_and_pruned():
    rng = np.random.default_rng(0)
    x = {s: rng.random(3000) for s in quality.STATISTICS}
    label = np.where((x["symbols"] > 0.8) | (x["digits"] > 0.7) & (x["marks"] < 0.3), 0, 1)
    third = rng.random(3000) < 1 / 3
    rules = quality.learn(x, label, third)
    fresh = {s: rng.random(2000) for s in quality.STATISTICS}
    true = np.where((fresh["symbols"] > 0.8) | (fresh["digits"] > 0.7) & (fresh["marks"] < 0.3), 0, 1)
    assert rules.label == 0 and (rules.verdicts(fresh) == true).mean() > 0.97
    assert {c.name for r in rules.rules for c in r} <= {"symbols", "digits", "marks"}
    noise = quality.learn(x, rng.integers(0, 2, 3000), third)
    assert len(noise.rules) <= 1  # nothing to be learned
    assert quality.learn(x, np.ones(3000, int), third).rules == []
    assert (quality.DecisionList().verdicts(x) == 1).all()


def test_best_condition_is_the_best_of_all():
    rng = np.random.default_rng(2)
    x = {s: rng.integers(0, 5, 60).astype(float) for s in quality.STATISTICS}
    hit = rng.random(60) < 0.4
    gain, found = quality.best_condition(x, hit)
    before, most = math.log2(hit.mean()), 0.0
    for name, v in x.items():
        for cut in (0.5, 1.5, 2.5, 3.5):
            for covered in (v >= cut, v < cut):
                p = int((covered & hit).sum())
                if p:
                    most = max(most, p * (math.log2(p / covered.sum()) - before))
    assert gain == pytest.approx(most) and found is not None


def test_expressions_agree_with_the_list(spark):
    rng = np.random.default_rng(4)
    c = quality.Condition
    rules = quality.DecisionList(0, [(c("symbols", True, 0.2), c("n_words", True, 3.0)), (c("capitals", True, 0.5),), (c("distinct", False, 0.4),)], [1.0] * 3)
    texts = [*ODD, *(" ".join(rng.choice(["ab", "CD", "#", "e f"], rng.integers(1, 90))) for _ in range(60))]
    frame = spark.createDataFrame([(i, t, 7, "k", True) for i, t in enumerate(texts)], "doc_id long, text string, n_words int, rule string, kept boolean")
    got = {r["doc_id"]: r for r in quality.judge(frame, rules).collect()}
    for i, t in enumerate(texts):
        counts = dict(zip(quality.COUNTS, quality.count_text(t)))
        x = {"n_words": counts["n_words"], **{n: counts[a] / counts[b] if counts[b] else 0.0 for n, a, b in quality.RATIOS}}
        held = [k for k, r in enumerate(rules.rules, 1) if all(q.holds({s: np.array([v]) for s, v in x.items()})[0] for q in r)]
        failed = counts["n_words"] < 50 or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]
        r = got[i]
        assert (r["_n_words"], r["base_failed"], r["_rule"], r["_kept"]) == (counts["n_words"], failed, held[0] if held else None, not failed and not held)
        assert (r["n_words"], r["rule"], r["kept"]) == (7, "k", True)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(None, "a " * 60), (1, None), (2, ""), (2, "b c " * 40)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(None, 0), (1, None), (2, 0), (2, 1), (3, 5)], "doc_id long, quality int")
    for labels in (none, odd):
        rules = quality.fit(docs, labels)
        assert rules.rules == [] and quality.judge(docs, rules).count() == 4
    assert quality.judge(docs.limit(0), quality.DecisionList()).count() == 0


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    held_out = id_remainder(4) == 2
    rules = quality.fit(docs, labels.where(~held_out))
    rows = quality.judge(docs, rules).join(labels.where(held_out), "doc_id").where("not base_failed").select("kept", "quality").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.97 * len(rows)
    assert all(r["kept"] for r in rows if r["quality"] == 1)


def test_queries_are_registered():
    assert {"op11_pivot_codes", "op12_collocations", "op13_quality"} <= set(queries.QUERIES)
    assert {"op11_pivot_codes", "op12_collocations"} <= set(queries.ORACLE)


def test_languages_that_differ_by_a_nul_at_their_end_stay_apart(spark):
    from critiq.llm.collocations import collocations

    rows = [("x\x00", "one two. end")] * 31 + [("x", "one two. one")] * 40
    got = {tuple(r) for r in collocations(spark.createDataFrame(rows, "lang string, text string")).collect()}
    assert got == {("x\x00", 1, "one two", 31, 31, 31, 93, 1000000), ("x", 1, "one two", 40, 80, 40, 120, 666666)}
