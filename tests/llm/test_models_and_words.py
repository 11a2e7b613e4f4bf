"""Whitening, 3-gram scoring and spelling variants against dense, plain and brute-force versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from amperine.llm import language_model, spelling, whitening
from amperine.llm.elias_fano import Sequence, Trie, encode

SCHEMA = "doc_id long, text string, row long, train string, word string, list string, block string"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# whitening


def dense(rows, components):
    x = np.floor(64 * np.array(rows, float)) + 1_000_000
    centred = x - x.sum(0) / len(x)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return values, centred @ vectors / np.sqrt(values), values / (centred**2).sum() * len(x)


@pytest.mark.parametrize("dimension, wanted", [(5, 32), (64, 32), (260, 20)])
def test_leading_pairs_equal_a_dense_solver(dimension, wanted):
    rng = np.random.default_rng(dimension)
    rows = rng.standard_normal((3 * dimension, dimension)) * np.linspace(1, 3, dimension)
    matrix = rows.T @ rows / len(rows)
    values, vectors, residuals = whitening.leading(lambda thin: matrix @ thin, dimension, wanted)
    want = np.linalg.eigvalsh(matrix)[::-1][: min(wanted, dimension)]
    assert np.abs(values - want).max() < 1e-12 * want[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-11 * want[0]
    assert residuals.max() < 1e-11 * want[0]


def test_leading_finds_repeated_and_missing_values():
    matrix = np.diag([4.0] * 20 + [1.0] * 10 + [0.0] * 70)
    values, vectors, _ = whitening.leading(lambda thin: matrix @ thin, 100, 35)
    assert np.allclose(values, [4.0] * 20 + [1.0] * 10 + [0.0] * 5, atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(35), atol=1e-12)


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(4)
    good = (rng.standard_normal((300, 12)) * np.linspace(0.2, 2, 12)).round(5).tolist()
    rows = [(i, v, 7, "x") for i, v in enumerate(good)] + [(0, good[0], 1, "y"), (None, good[1], 1, None)]
    bad = [None, [], [1.0], [None, *good[0][1:]], [math.nan, *good[0][1:]], [math.inf, *good[0][1:]]]
    rows += [(1000 + i, v, 0, "z") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, component string").repartition(3)
    got = whitening.whiten(df, components=8).toPandas()
    used = [v for _, v, *_ in rows if v and len(v) == 12 and None not in v and np.isfinite(v).all()]
    values, white, explained = dense(used, 8)
    assert len(got) == 8 * len(used) == 8 * 302 and (got.n == 302).all()
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    for c in range(8):
        mine = got[got.component == c + 1].set_index("vec_id").whitened
        order = [k for k in range(1, 300)]
        ours, theirs = mine.loc[order].to_numpy(), white[1:300, c]
        assert np.abs(ours * np.sign(ours @ theirs) - theirs).max() < 1e-8
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in used]
    sums = [sum(c) for c in zip(*x)]
    want = Counter(sum((302 * c - s) ** 2 for c, s in zip(v, sums)) for v in x)
    assert Counter(int(d) for d in got[got.component == 1].deviation) == want


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None), (2, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 0.0, 5.0]) for i in range(9)], schema)
    assert {r.component for r in whitening.whiten(line).collect()} == {1}


def test_sums_are_added_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(400)], "vec_id long, embedding array<float>")
    blocks = whitening.Blocks(df.repartition(20), "vec_id", "embedding")
    blocks.rows = blocks.rows.repartition(11)
    assert blocks.sums == [64 * sum(i % 7 for i in range(400)), 64 * sum(i % 5 for i in range(400))]
    x = 64 * np.array([[i % 7, i % 5] for i in range(400)], float)
    assert np.allclose(blocks.product(np.eye(2)), np.cov(x.T, bias=True))


def test_deviations_beyond_a_long_stay_exact():
    far = np.array([[2**40, 0], [0, 2**40]])
    assert whitening.deviations(far, 2, far.sum(0).tolist()) == [2 * 2**80] * 2


# n-grams


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (1, 2**63), (5, 5), (1000, 10), (1000, 2**40), (5000, 2**64 - 1)])
def test_elias_fano_access_and_successor(n, most):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, most, n, dtype=np.uint64))
    sequence = Sequence(encode(values))
    assert (sequence[np.arange(n)] == values).all()
    asked = np.concatenate([values, rng.integers(0, min(most + 5, 2**64 - 1), 300, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    place, equal = sequence.successor(asked)
    assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def test_trie_finds_exactly_its_grams():
    rng = np.random.default_rng(1)
    grams = sorted({tuple(g) for g in rng.integers(0, 12, (400, 3)).tolist()})
    pairs = sorted({g[:2] for g in grams})
    firsts = sorted({g[0] for g in grams})
    trie = Trie(
        np.array(firsts), np.array([p[1] for p in pairs]), np.array([g[2] for g in grams]),
        np.array([firsts.index(p[0]) for p in pairs]), np.array([pairs.index(g[:2]) for g in grams]), {"x": np.arange(3)},
    )
    for a in range(14):
        one, found = (x[0] for x in trie.word(np.array([a])))
        assert found == (a in firsts)
        for b in range(14) if found else ():
            two, found = (x[0] for x in trie.child("two", np.array([one]), np.array([b])))
            assert found == ((a, b) in pairs)
            for c in range(14) if found else ():
                place, found = (x[0] for x in trie.child("three", np.array([two]), np.array([c])))
                assert found == ((a, b, c) in grams) and (not found or grams[place] == (a, b, c))


def plain_scores(rows, m2, m3):
    docs = [(k, [w for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())] + [None], tr) for k, t, tr in rows]
    c1, c2, c3, k1, k2 = (Counter() for _ in range(5))
    for _, words, train in docs:
        if train:
            s = [0, 0, *words, 1, 1]
            c1.update(words)
            for a, b, c in zip(s, s[1:], words):
                c3[a, b, c] += 1
                c2[b, c] += 1
            k1.update(s)
            k2.update(zip(s, s[1:]))
    total, out = sum(c1.values()), []
    for key, words, _ in docs:
        base = score = 0.0
        for a, b, c in zip([0, 0, *words], [0, *words], words):
            p1 = (c1[c] + 0.5) / (total + 0.5 * (len(c1) + 1))
            p2 = (c2[b, c] + m2 * p1) / (k1[b] + m2)
            p3 = (c3[a, b, c] + m3 * p2) / (k2[a, b] + m3)
            base, score = base + math.log10(p1), score + math.log10(p3)
        out.append((str(key), len(words), sum(c1[w] > 0 for w in words), total, base, score))
    return sorted(out)


def texts():
    rng = np.random.default_rng(2)
    words = ["the", "The", "cat", "sat", "größe", "x" * 700, "x" * 699 + "y", "a", "b", "on"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 40))), i % 5 != 1) for i in range(60)]
    rows += [(100, None, True), (101, "", True), (102, " \n\t ", False), (None, "the cat", True), (None, None, False)]
    # one context with most of all entries, followed by many words
    rows += [(103, " ".join(f"the the w{i}" for i in range(4000)), True), (104, "on the " * 900, True), (104, "on the " * 900, True)]
    return rows


@pytest.mark.parametrize("block, shard, common", [(1 << 20, 1 << 22, 1 << 17), (700, 300, 30), (5000, 300, 0)])
def test_scores_equal_plain_counting(spark, monkeypatch, block, shard, common):
    monkeypatch.setattr(language_model, "COMMON", common)
    monkeypatch.setattr(language_model, "BLOCK", block)
    monkeypatch.setattr(language_model, "SHARD", shard)
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").withColumns(
        {"row": F.lit("x"), "block": F.lit(1), "n_tokens": F.lit(None)}).repartition(3)
    got = language_model.score(df, F.col("learn"), m2=50.0, m3=3.0).collect()
    want = plain_scores(rows, 50.0, 3.0)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(want, key=lambda r: r[:2])):
        assert (str(g.doc_id), g.n_tokens, g.n_known, g.train_tokens) == w[:4]
        assert abs(g.base_score - w[4]) < 1e-9 * (1 + abs(w[4])) and abs(g.score - w[5]) < 3e-4 * g.n_tokens


def test_scores_of_nothing(spark, empty):
    assert language_model.score(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = language_model.score(one, F.lit(False)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_probabilities_sum_to_one(spark):
    """Over all known words and one unknown word, behind a seen and an unseen context."""
    known = ["a", "b", "c"]
    train = [(i, t, True) for i, t in enumerate(["a b c", "a b a", "b b c a"])]
    for context in ("a b", "c q"):
        ends = [(10 + i, f"{context} {w}", False) for i, w in enumerate([*known, "unknown"])] + [(20, context, False)]
        rows = plain_scores([*train, *ends], 5.0, 2.0)
        df = spark.createDataFrame([*train, *ends], "doc_id long, text string, learn boolean")
        got = {str(r.doc_id): r.score for r in language_model.score(df, F.col("learn"), m2=5.0, m3=2.0).collect()}
        assert all(abs(got[r[0]] - r[5]) < 1e-3 for r in rows)


def test_long_texts_are_cut_at_blanks(monkeypatch):
    monkeypatch.setattr(language_model, "CHARS", 50)
    text = "Alpha beta " * 40 + "y" * 300 + " gamma"
    whole = np.concatenate([language_model.word_hashes(w.encode())[0] for w in text.split()])
    assert (list(language_model.texts_as_hashes([None, text, "a"]))[1] == whole).all()


# spelling


def brute_variants(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    others = {w: [o for o in n if o != w and near(w, o)] for w in n}
    form = {}
    for w, mine in others.items():
        if mine:
            best = min(mine, key=lambda o: (-n[o], o))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(others[w]), n.get(form.get(w))) for w in n)


def spelled():
    rng = np.random.default_rng(5)
    words = ["recieve", "receive", "received", "deceive", "Größere", "größere", "aaaaaaaa", "aaaaaaa", "aaaaaab", "banana",
             "ananas", "bananas", "Élégant", "÷÷÷÷÷÷", "short", "abcdef", "bcdefg", "abcdefg", "l" * 400, "l" * 401, "colour", "colours", "colourss"]
    weights = np.array([1, 300, 40, 3, 3, 60, 2, 20, 90, 5, 5, 30, 9, 9, 50, 9, 9, 50, 9, 9, 0.8, 7, 90], float)
    rows = [(i, " 1-".join(rng.choice(words, 150, p=weights / weights.sum()))) for i in range(60)]
    letters = list("aé")
    rows += [(i, " ".join("".join(rng.choice(letters, rng.integers(6, 9))) for _ in range(60)) + " ") for i in range(60, 160)]
    return [*rows, rows[0], rows[0], (None, "receive " * 30), (500, None), (501, ""), (502, "12 ?!")]


def test_variants_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 200)
    rows = spelled()
    df = spark.createDataFrame([(k, t, 1, "a", "b", "c", "d") for k, t in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in spelling.variants(df).collect())
    want = brute_variants(rows)
    assert got == want and any(w[1] and w[2] != w[1] for w in want) and any(w[4] > 3 for w in want)


def test_variants_of_nothing(empty):
    assert spelling.variants(empty).count() == 0


@pytest.mark.parametrize("frequent, most", [(1, 10**6), (4, 10**6), (4, 40)])
def test_no_near_pair_is_lost_with_any_dictionary(spark, frequent, most):
    rng = np.random.default_rng(6)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(6, 12))) for _ in range(700)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    known = spelling.gram_dictionary(spelling.gram_counts(df), most, frequent)
    assert len(known) <= most or most == 40 and all(len(g) == 2 for g in known)
    got = {(r.word, r.near) for r in spelling.near_pairs(df, known).collect()}
    holes = defaultdict(set)
    for w in words:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
            holes[w[:i] + "?" + w[i + 1 :]].add(w)
    want = {(a, b) for gap, ws in holes.items() for a in ws for b in ws
            if a != b and ("?" in gap or gap in (a, b))}
    assert got == want


def test_affected_grams_bound_the_loss():
    """After any one edit a word keeps all but `affected` of its grams, at one of its two distances."""
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("ab"), rng.integers(6, 10))) for _ in range(60)]
    grams = Counter(w[p : p + q] for w in words for q in range(2, 7) for p in range(len(w) - q + 1))
    known = {g: n for g, n in grams.items() if len(g) == 2 or grams[g[:-1]] > 8}
    for word in words:
        edited = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abc"} - {word}
        for other, longest in [*((o, len(word)) for o in edited), *((word[:i] + word[i + 1 :], len(word)) for i in range(len(word)))]:
            most = min(spelling.GRAM_MOST, longest // 2)

            def places(w):
                own = spelling.decompose(w, known, most)
                return own, {("<", p, w[p : p + q]) for p, q in own} | {(">", len(w) - p - q, w[p : p + q]) for p, q in own}

            mine, _ = places(word)
            _, theirs = places(other)
            kept = sum(("<", p, word[p : p + q]) in theirs or (">", len(word) - p - q, word[p : p + q]) in theirs for p, q in mine)
            assert kept >= len(mine) - spelling.affected(mine, len(word), most, False) >= 1
