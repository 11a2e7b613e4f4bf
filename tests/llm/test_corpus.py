"""Corpus operators against brute force on small tables with nulls, ties, repeats and long texts."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from amperine.llm import completion, exact, language, minhash, mixing, packing, quality, rules, toxicity, urls, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, _key string, size string, recipe string"
BASE = "the cat sat on the mat and looked at the grey sky over the old town while it rained all day long"


def variants():
    words = BASE.split()
    texts = [BASE, BASE, BASE.upper(), " ".join(words[:-1]), " ".join(words[1:]), " ".join(["x", *words])]
    return [*texts, None, "", "  \n\t", "one", "one", "ONE", "zwei wörter", "a b a b a b a b", "word " * 30_000, "12 34 !?"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s1" if i % 3 else None, 0, 7, "k", "z", "r") for i, t in enumerate(variants())]
    rows += [(None, BASE, None, "s2", None, None, None, None, None), rows[0], rows[0]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_packing_places_every_token_once(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = packing.pack_documents(docs, TOKENIZER, with_ids=True).collect()
    got = sorted((str(p.doc_id), p.piece, p.start, p.length, p.ids_crc32) for p in pieces)
    want = []
    for row in docs.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own = np.asarray(ids[start : start + 4096], "<u4")
            want.append((str(row.doc_id), piece, start, len(own), zlib.crc32(own.tobytes())))
    assert got == sorted(want)
    places = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.asarray(p.ids, "<u4").tobytes()) == p.ids_crc32
        places[p.sequence_id].append((p.offset, p.length))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 4096


@pytest.mark.parametrize("text", [
    "it's a Test's o'clock don't", "ΑΣ ΣΑΣ.", "İstanbul x", "á éx", "日本語 テスト。ok", "1234 a1b2 ٣ x²", "a.,b ''s ...",
    "<|endoftext|> x", "ﬁ ß ẞ Ǆ.", "''ll ,'re", "x\u00a0y z", "Å Ω K", "“y”.", "thnd*** iner### a,%%%", "",
])
def test_word_cache_equals_the_tokenizer(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert np.frombuffer(packing.word_ids([text], TOKENIZER)[0], "<u4").tolist() == want


def test_bin_completion_reaches_the_least_number_of_bins():
    def least(sizes, capacity):
        best = len(sizes)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(sizes):
                best = len(rooms)
                return
            for k, room in enumerate(rooms):
                if sizes[i] <= room and room not in rooms[:k]:
                    place(i + 1, [*rooms[:k], room - sizes[i], *rooms[k + 1 :]])
            place(i + 1, [*rooms, capacity - sizes[i]])

        place(0, [])
        return best

    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = sorted(rng.integers(1, 30, 9).tolist(), reverse=True)
        bins = completion.bin_completion(Counter(sizes), 30)
        assert Counter(x for b in bins for x in b) == Counter(sizes) and max(map(sum, bins)) <= 30
        assert len(bins) == least(sizes, 30) >= completion.lower_bound(Counter(sizes), 30)


def test_exact_groups(docs):
    got = exact.duplicate_groups(docs)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    groups = defaultdict(list)
    for key, text in rows:
        groups[text].append(-1 if key is None else key)
    want = []
    for key, text in rows:
        want.append((key, max(groups[text]), len(groups[text]), hashlib.sha256(text.encode()).hexdigest()))
    assert collected(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=str)
    assert got.filter("kept").count() == len(groups)
    assert got.filter("kept and doc_id <> keep_id").count() == 0


def test_exact_dedup_survives_ambiguous_digests(docs):
    digests = (lambda c: F.xxhash64(c) % 2, lambda c: F.sha2(c, 256))
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    got = exact.duplicate_groups(docs, digests=digests)
    assert collected(got, *columns) == collected(exact.duplicate_groups(docs), *columns)
    with pytest.raises(ValueError):
        exact.duplicate_groups(docs, digests=digests[:1])


def test_chunks_put_together_are_the_text(spark):
    texts = ["", "a", "word " * 5000, "x" * 20_000, "é\n ü, " * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, parts in df.select("text", exact.chunks(F.col("text"))).collect():
        assert "".join(parts) == text and all(len(p) <= 4096 for p in parts)


def brute_groups(rows, size):
    """component by key, from all pairs."""
    sets = {k: minhash.shingles(t, size) for k, t in rows if k is not None}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in sets}, {k: len(s) for k, s in sets.items()}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    component, count = brute_groups(rows, size)
    got = minhash.near_duplicates(docs, size=size).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles) == (component[r.doc_id], count[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_chain_of_near_copies_in_one_bucket(spark, monkeypatch):
    """Neighbours of a chain are similar, its ends are not; blocks are as small as they can be."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = np.random.default_rng(0)
    words, rows = [f"w{i}" for i in range(120)], []
    for key in range(60):
        rows.append((key, " ".join(words)))
        for _ in range(int(rng.integers(2, 9))):
            words[rng.integers(len(words))] = f"n{rng.integers(10**6)}"
    component, _ = brute_groups(rows, 2)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2)
    assert {r.doc_id: r.component_id for r in got.collect()} == component


def test_mixing_hits_targets_and_repeats_itself(docs):
    got = mixing.mix_plan(docs).collect()
    assert len(got) == docs.count()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        assert 0 <= r.taken <= 2 * r.size
    targets = {r.source: r.target for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source, target in targets.items():
        largest = max(r.size for r in got if r.source == source)
        assert target <= 2 * sizes[source]
        assert abs(sum(r.taken for r in got if r.source == source) - target) <= 2 * largest
    again = mixing.mix_plan(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(docs).columns == docs.columns


def test_buckets_do_not_change_how_much_is_taken(spark):
    rows = [(i, "word " * (i % 50), "s", ) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    small = mixing.mix_plan(df, bucket_rows=7, weights=(1,)).agg(F.sum("taken"), F.first("target")).first()
    assert abs(small[0] - small[1]) <= 100


def labelled(spark, n=600):
    rng = np.random.default_rng(1)
    vocabulary = {"en": ["the", "house", "with", "green", "and", "water"], "fr": ["maison", "avec", "verte", "et", "eau", "les"]}
    rows, labels = [], []
    for i in range(n):
        lang = "en" if i % 2 else "fr"
        words = rng.choice(vocabulary[lang], 80).tolist()
        words = [w + str(rng.integers(10)) if rng.random() < 0.2 else w for w in words]
        bad, toxic = i % 5 == 0, i % 7 == 0 and i % 5 > 0
        text = " ".join(w + "###" if bad else w for w in words)
        if toxic:
            text += " you idiot"
        rows.append((i, text, lang))
        labels.append((i, 0 if bad else 1, 1 if toxic else 0))
    edge = [(n, None, None), (n + 1, "", "en"), (n + 2, "12 !?", "fr"), (None, "house", "en"), rows[1]]
    return (
        spark.createDataFrame(rows + edge, "doc_id long, text string, lang string").repartition(3),
        spark.createDataFrame(labels + [(3, None, None), (4, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"),
    )


def test_language_of_held_out_rows(spark):
    df, _ = labelled(spark)
    got = language.identify(df).join(df.select("doc_id", "lang").distinct(), "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.doc_id < 600:
            assert r.lang_pred == r.lang
        else:
            assert r.lang_pred == "und" and r.rejected and r.score == 0
    kept = language.keep_recognised(df, language.fit(language.training_rows(df)))
    assert kept.columns == df.columns and kept.filter("text is null or text in ('', '12 !?')").isEmpty()
    unknown = language.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


def test_quality_of_held_out_rows(spark):
    df, labels = labelled(spark)
    got = quality.score_documents(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and all(r.predicted == (0 if r.doc_id % 5 == 0 else 1) for r in held)
    without = quality.score_documents(df, labels.limit(0)).collect()
    assert {r.score for r in without} == {0.5}


def test_context_sums_against_a_loop(spark):
    texts = ["a b c a", "", "b b, c"]
    want, index = np.zeros((quality.BUCKETS, quality.WIDTH), np.int64), quality.index_vectors()
    for text in texts:
        place, _ = quality.buckets([text])
        for i, p in enumerate(place):
            for j in range(max(0, i - 2), min(len(place), i + 3)):
                if i != j:
                    want[p] += index[place[j]]
    got = quality.context_sums(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert (got == want).all()


def test_toxicity_chain(spark):
    df, labels = labelled(spark)
    marks = labels.select("doc_id", (1 - F.col("quality")).alias("unfit"), "toxic")
    got = toxicity.classify(df, marks, ["unfit", "toxic"]).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id is not None and r.doc_id < 600:
            assert (r.p_toxic >= 0.5) == (r.doc_id % 7 == 0 and r.doc_id % 5 > 0)
    none = toxicity.classify(df, marks.limit(0), ["unfit", "toxic"]).collect()
    assert {(r.p_unfit, r.p_toxic) for r in none} == {(0.0, 0.0)}


def test_rule_counts_against_a_loop():
    for text in [None, "", "a b c a b c", "x\ny\nx\n \n", "a a a a", "AB #c$ d|\nAB #c$ d|"]:
        words = (text or "").split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = {w for w in windows if windows.count(w) > 1}
        held = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
        lines = [line for line in (text or "").split("\n") if line.split()]
        dup = sum(line in lines[:i] for i, line in enumerate(lines))
        signs = sum(c in "#*$%&|<>" for c in text or "")
        assert rules.text_counts(text)[:5] == (len(words), sum(map(len, words)), signs, dup, len(held))


def test_learned_rules_equal_their_expression(spark):
    df, labels = labelled(spark)
    learned = rules.fit(df, labels)
    assert learned
    got = rules.judge(df, learned).collect()
    assert len(got) == df.count()
    for r in got:
        x = {f: np.array([getattr(r, a) / max(getattr(r, b), 1)]) for f, (a, b) in rules.FEATURES.items()}
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base
        assert r.kept == (not base and not any(rules.holds(rule, x)[0] for rule in learned))
        if not base and r.doc_id is not None and r.doc_id < 600:
            assert r.kept == (r.doc_id % 5 > 0)
    assert rules.fit(df, labels.limit(0)) == []


def test_url_rules_against_a_loop(spark):
    table = [*urls.RULES, ("example.net", "/en", urls.BLOCK), ("b.c", "", urls.BLOCK), ("a.b.c", "/x/y", urls.ALLOW)]
    addresses = [
        None, "", "no scheme", "http://", "http://NET/", "http://x.Example.NET/en/1?x#y", "http://notexample.net/en/",
        "http://x.net", "http://x.net?/en/", "ftp://a.b.c/x/yz", "http://b.c", "http://q.b.c#f", "http://example.com/de",
        "http://m.example.com/de/ü", "http://example.org/fr/1", "a://b://c/", "http://a..net//en/",
    ]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(addresses)] + [(None, addresses[4]), (4, addresses[4])], "page_id long, url string")
    got = urls.judge(pages, spark.createDataFrame(table, "host string, path string, verdict string"))
    def judged(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
            path = rest[end:].split("?")[0].split("#")[0]
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in table
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        return host, path, best and best[3], best[4] if best else "allow"
    want = [(k, *judged(u)) for k, u in [*enumerate(addresses), (None, addresses[4]), (4, addresses[4])]]
    assert collected(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=str)
    plain = urls.judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r.verdict for r in plain.collect()} == {"allow"}


def test_warc_round_trip_in_small_ranges(spark):
    html = ["<p>ü</p>" * 50, None, "", "x" * 300_000, "<p>ü</p>" * 50, "\x1f\u008b\x08", "last"]
    rows = [(i, f"http://a/{i}\r\nX: y", h) for i, h in enumerate(html)] + [(None, None, "last"), (4, "u", html[4])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = warc.round_trip(pages).collect()
    groups = defaultdict(list)
    for key, _, h in rows:
        groups[h or ""].append(-1 if key is None else key)
    assert len(got) == len(rows)
    assert Counter(r.record_type for r in got)["response"] == len(groups)
    sizes = {key: (h or "").encode() for key, _, h in rows}
    for r in got:
        data = sizes[r.page_id]
        first = max(groups[data.decode()])
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert r.refers_to == (first if r.record_type == "revisit" else None)
        assert r.record_type == "revisit" or r.page_id == first or (first == -1 and r.page_id is None)
    files = warc.write(pages)
    whole = collected(warc.read(spark, files, with_payload=True), "page", "record_type", "start", "payload")
    for size in (97, 1000):
        assert collected(warc.read(spark, files, size, with_payload=True), "page", "record_type", "start", "payload") == whole


def test_every_operator_takes_an_empty_table(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rules_table = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    for df in (
        packing.pack_documents(empty, TOKENIZER), exact.duplicate_groups(empty), minhash.near_duplicates(empty),
        mixing.mix_plan(empty), language.identify(empty), quality.score_documents(empty, labels),
        toxicity.classify(empty, labels, ["toxic"]), rules.judge(empty, rules.fit(empty, labels)),
        urls.judge(pages, rules_table), warc.round_trip(pages),
    ):
        assert df.count() == 0


def test_stages_keep_columns_and_pack_what_is_left(docs, spark):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, None)
        assert frame.columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"
    ]
    unique = minhash.keep_one_each(exact.drop_copies(docs))
    ids = [r.doc_id for r in unique.collect()]
    assert len(ids) == len(set(ids))


def mixed(rows):
    """Times that each (doc_id, text, source) is taken, by a plain loop over sources and sizes."""
    number = lambda text, digits: int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)
    sized = defaultdict(list)
    for key, text, source in rows:
        sized[source].append((len(re.findall(r"[^\x20\x09-\x0D]+", text)), key))
    names = sorted(sized, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, _ in sized[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, mass, open_ = {}, 1.5 * sum(total.values()), list(names)
    while full := [s for s in open_ if 2 * total[s] <= mass / sum(weight[o] for o in open_) * weight[s]]:
        for s in full:
            target[s] = 2.0 * total[s]
            mass -= target[s]
            open_.remove(s)
        if not open_:
            break
    target |= {s: mass / sum(weight[o] for o in open_) * weight[s] for s in open_}
    taken = Counter()
    for s in names:
        each, offset = target[s] / total[s], number("mix" + (s or ""), 13) / 2**52
        for rank, (_, key) in enumerate(sorted(sized[s]), 1):
            taken[key] += int(rank * each + offset) - int((rank - 1) * each + offset)
    return taken


def test_pipeline_against_a_loop_over_its_stages(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # of one language only, so a text is recognised if it has a letter
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    unique = {}
    for row in rows:
        if row[1] not in unique or (unique[row[1]][0] or -1) < (-1 if row[0] is None else row[0]):
            unique[row[1]] = row
    component, _ = brute_groups([(k, t) for k, t, _ in unique.values()], 5)
    left = [row for row in unique.values() if component[row[0]] == row[0]]
    assert len(rows) > len(unique) > len(left) > 3
    taken, tokenizer, want = mixed(left), Tokenizer.from_file(TOKENIZER), Counter()
    assert set(taken.values()) > {1}
    for key, text, _ in left:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        for piece, start in enumerate(range(0, n, 4096)):
            want[key, piece, start, min(4096, n - start)] += taken[key]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((p.doc_id, p.piece, p.start, p.length) for p in pieces) == +want
    places = defaultdict(list)
    for p in pieces:
        places[p.sequence_id].append((p.offset, p.length))
    for own in places.values():
        ends = [0, *(offset + length for offset, length in sorted(own))]
        assert all(end == offset for end, (offset, _) in zip(ends, sorted(own))) and ends[-1] <= 4096
