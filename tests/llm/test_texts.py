"""Corpus operators against brute force, round trips and libraries, on small fixtures with the odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqframe.llm import decontaminate, html_text, katz, mixing, quality, surrogates, token_counts, token_store

P = pytest.importorskip("public_tokenizers")
ODD = ["", None, " ", "\n\n", "a", "日本語 テスト", "ÀÉ ß ﬁ", "x<|endoftext|>y", "don't 're 'r", "a\x1cb", "w " * 3000, "á é"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# ------------------------------------------------------------ decontamination


def brute_leaks(text, items, window=10):
    w, hit, ids = words(text), set(), set()
    for item, body in items:
        x = words(body)
        for k in range(max(1, len(x) - window + 1) if x else 0):
            part = x[k : k + window]
            for at in range(len(w) - len(part) + 1):
                if w[at : at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    ids.add(item)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None), bool(hit)


def leak_fixture():
    rng = random.Random(3)
    vocabulary = ["ab", "cd", "É", "x1", "Zz", "m"]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([12, 3, 10, 30, 11])] + [(5, ""), (6, None), (None, "only here three"), (1, "second text of one")]
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(20)] + [f"p {items[3][1]}! q", items[0][1].upper() + ".", "say ONLY, here three; times", "second text of one"] + ODD
    return items, texts


@pytest.mark.parametrize("limit", [4 << 20, 60])
def test_leaks_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", limit)
    items, texts = leak_fixture()
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)] + [(0, texts[0], "clash")], "doc_id long, text string, spans string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.leak_digest(decontaminate.find_leaks(docs, benchmark)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        n, hit, ids, flag = brute_leaks(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(ids), flag)
        assert r["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, t in enumerate(texts) if not brute_leaks(t, items)[3]}


def test_spans_point_to_the_original(spark):
    docs = spark.createDataFrame([(1, "Ünd so: (One, TWO - three) end")], "doc_id long, text string")
    found = decontaminate.find_leaks(docs, spark.createDataFrame([(7, "one two three")], "item_id long, text string")).first()
    span = found["spans"][0]
    assert docs.first()["text"][span["char_start"] : span["char_end"]] == "One, TWO - three" and found["n_words"] == 6


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leak_digest(decontaminate.find_leaks(docs, items)).collect() == []
    assert mixing.mix_plan(docs.withColumn("source", F.lit("x"))).collect() == []
    assert token_store.store_tokens(docs, P.path("word_bpe_49k.json")).collect() == []
    assert katz.score(docs, F.lit(True)).collect() == []
    assert surrogates.replace_pii(docs, b"k").collect() == []
    one = docs.sparkSession.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.leak_digest(decontaminate.find_leaks(one, items)).first()["contaminated"] is False


# ------------------------------------------------------------ mixing


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(400)] + [(0, "w w w", "b"), (900, None, "a"), (901, "", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows) and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in plan)
    sizes = Counter()
    for k, t, s in rows:
        sizes[s] += len((t or "").split())
    named = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(named, [3, 1, 2] * 9, strict=False))
    full, budget = set(), 1.5 * sum(sizes.values())
    while True:
        rest, open_ = budget - sum(2 * sizes[s] for s in full), sum(weight[s] for s in named if s not in full)
        want = {s: 2 * sizes[s] if s in full else rest * weight[s] / open_ for s in named}
        over = {s for s in named if s not in full and want[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    by_size = defaultdict(int)
    for r in plan:
        by_size[(r["source_size"], r["target"])] += r["taken"]
    assert all(abs(t - goal) <= 0.5 for (_, goal), t in by_size.items())
    assert {round(g, 6) for _, g in by_size} == {round(x, 6) for x in want.values()}
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plan))
    assert sum(len((r["text"] or "").split()) for r in mixing.mix(docs).collect()) == sum(r["taken"] for r in plan)


def test_subset_sums_are_as_near_as_can_be():
    rng = random.Random(4)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 30), 4))
        counts = [rng.randint(1, 3) for _ in lengths]
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + k * n for s in sums for k in range(c + 1)}
        goal = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        take = mixing.fit_counts(np.array(lengths), np.array(counts), goal)
        assert (take <= np.array(counts)).all() and (take >= 0).all()
        got = int((take * np.array(lengths)).sum())
        assert abs(got - goal) == min(abs(x - goal) for x in sums)


def test_large_budgets_and_few_long_documents():
    rng = np.random.default_rng(5)
    lengths = np.unique(rng.integers(1, 20_000, 3000))
    counts = rng.integers(1, 50, len(lengths))
    for goal in (int((lengths * counts).sum() * 0.37), int((lengths * counts).sum()), 0, 70_000):
        take = mixing.fit_counts(lengths, counts, goal)
        assert (take <= counts).all() and (take >= 0).all() and int((take * lengths).sum()) == goal
    take = mixing.fit_counts(np.array([0, 400_000, 1_000_000]), np.array([5, 2, 1]), 1_390_000)
    assert take.tolist() == [0, 1, 1]


def test_mix_of_ties_clashing_columns_and_empty_tables(spark):
    rows = [(1, "a b", "s"), (1, "a c", "s"), (None, "a d", "s"), (None, "a d", "s"), (2, "a e f g", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as target", "'x' as row", "5 as h", "6 as rank", "7 as copies")
    once, again = (sorted(map(str, mixing.mix(d).collect())) for d in (docs, docs.repartition(3)))
    assert once == again and len(once) >= 5
    assert sorted(map(str, mixing.mix_plan(docs).collect())) == sorted(map(str, mixing.mix_plan(docs.repartition(3)).collect()))
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mix_plan(docs.limit(0)).collect() == []


# ------------------------------------------------------------ quality


def test_quality_tells_layouts_apart_and_handles_nulls(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    good = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(6)) + "."
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(50))
    rows = [(k, good() if k % 3 else bad()) for k in range(240)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(240)] + [(5, None), (5000, 1)], "doc_id long, quality int")
    held = quality.crc("doc_id", 5) == 0
    weights = quality.fit(docs, labels, ~held, updates=2000)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, weights).collect()}
    out = [k for k in range(240) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((scored[k] >= 0.3) == (k % 3 > 0) for k in out) and len(out) > 20
    assert 0 <= scored[1000] == scored[1001] <= 1
    assert (quality.fit(docs, labels, ~held, updates=2000) == weights).all()


def test_quality_scores_are_dot_products(spark):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    weights = rng.normal(size=(1 << quality.BITS) + 1).astype(np.float32)
    rows = [(1, "One two, one TWO 12!"), (1, "One two, one TWO 12!"), (2, None), (3, ""), (None, "x"), (4, "long words " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__score", F.lit(1))
    got = sorted(((r["doc_id"] or -1, r["score"]) for r in quality.score(docs, weights).collect()))
    want = []
    for k, t in rows:
        numbers, _ = quality.features(pa.array([t or ""]))
        groups = len(quality._GROUPS)
        dot = groups * float(np.mean(weights[numbers].astype(float))) if len(numbers) else 0.0
        want.append((k or -1, 1 / (1 + math.exp(-np.clip(dot + weights[-1], -35, 35)))))
    assert [k for k, _ in got] == [k for k, _ in sorted(want)] and np.allclose([x for _, x in got], [x for _, x in sorted(want)])
    assert quality.score(docs.limit(0), weights).collect() == []


def test_quality_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, quality int")
    for d, x in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        weights = quality.fit(d, x, F.lit(True), updates=10)
        assert not weights.any()
        assert [r["score"] for r in quality.score(docs, weights).collect()] == [0.5] * 3


# ------------------------------------------------------------ language model


def test_katz_equals_brute_force_and_adds_up(spark, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 2000)
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(1, 60)))) for k in range(220)] + [(900 + k, t) for k, t in enumerate(ODD)] + [(3, "W1 w2\tw1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).sortWithinPartitions("doc_id", "text").cache()
    docs.count()
    got = defaultdict(list)
    for r in katz.score(docs, quality.crc("doc_id", 7) != 2).collect():
        got[r["doc_id"]].append(r)
    split = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.split("[\x20\x09-\x0d]+", t or "") if w] + [None]
    texts = [(k, split(t)) for k, t in rows]
    learnt = [t for k, t in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    uni = Counter(w for t in learnt for w in t)
    bi = Counter(p for t in learnt for p in zip([0, *t], t, strict=False))
    history = Counter()
    for (h, _), c in bi.items():
        history[h] += c
    total, types = sum(uni.values()), len(uni)
    d1, d2 = katz.discounts(Counter(uni.values()), 5), katz.discounts(Counter(bi.values()), 5)
    lost = sum(c * (1 - d1[c]) for c in uni.values() if c <= 5)
    scale = total + (0.5 if lost <= 0 else 0)
    p = lambda w: uni[w] * (d1[uni[w]] if uni[w] <= 5 else 1) / scale if w in uni else (lost or 0.5) / scale
    assert abs(sum(p(w) for w in uni) + p("never seen") - 1) < 1e-9
    mass = lambda c: c * (d2[c] if c <= 5 else 1)
    seen, prob = defaultdict(float), defaultdict(float)
    for (h, w), c in bi.items():
        seen[h] += mass(c) / (history[h] + 0.5)
        prob[h] += p(w)
    bow = lambda h: (1 - seen[h]) / (1 - prob[h]) if h in history else 1.0
    for k, t in texts:
        base = sum(math.log10((uni[w] + 1) / (total + types + 1)) for w in t)
        score = sum(math.log10(mass(bi[(h, w)]) / (history[h] + 0.5)) if (h, w) in bi else math.log10(bow(h) * p(w)) for h, w in zip([0, *t], t, strict=False))
        assert any(abs(r["score"] - score) < 1e-6 and abs(r["base_score"] - base) < 1e-6 and (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in uni for w in t), total) for r in got[k]), (k, t)


def test_a_stored_model_scores_other_documents(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(50)]
    make = lambda a, b: [(k, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(50)], k=rng.randint(1, 50)))) for k in range(a, b)]
    old, new = make(0, 150), [*make(150, 200), (200, None), (201, "never seen words"), (202, "w1 never w1"), (None, "w1"), (None, "w1")]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in [*old, *new]], "doc_id long, text string, block string, place int")
    known = F.coalesce(F.col("doc_id") < 150, F.lit(False))
    katz.fit(docs.filter(known), str(tmp_path / "model"))
    got = katz.apply(katz.load(spark, str(tmp_path / "model")), docs.filter(~known)).collect()
    want = [r for r in katz.score(docs, known).collect() if r["held_out"]]
    name = lambda r: (r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6), r["held_out"])
    assert sorted(map(name, got)) == sorted(map(name, want)) and len(got) == len(new)
    empty = katz.fit(docs.limit(0), str(tmp_path / "empty"))
    assert katz.apply(empty, docs.filter("doc_id = 202")).first()["n_tokens"] == 4


# ------------------------------------------------------------ tokens


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [(k * 3 % 31, t) for k, t in enumerate([*ODD, "Hello, world!! It's 42 o'clock", "Σίσυφος ΟΔΟΣ", "THE!! END%%%"])] + [(None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, start = [], 0
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_store.store_tokens(docs, P.path("word_bpe_49k.json")).collect()
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: r[1]) == want


@pytest.mark.parametrize("n", [0, 1, 5, 16383, 16384, 16385, 70000])
@pytest.mark.parametrize("symbols", [1, 2, 40000])
def test_codec_round_trip_and_damage(n, symbols):
    rng = np.random.default_rng(n + symbols)
    ids = (rng.zipf(1.3, n) % symbols).astype(np.uint32)
    lengths = np.array([n // 3, n - n // 3], np.uint32)
    file = token_store.encode(ids, lengths)
    back, sizes = token_store.decode(file)
    assert (back == ids).all() and (sizes == lengths).all()
    if n > 16384 and symbols > 2:
        broken = bytearray(file)
        broken[-50] ^= 255
        with pytest.raises((ValueError, IndexError)):
            token_store.decode(bytes(broken))


def test_counts_equal_the_library_at_every_prefix(spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    texts = [*ODD, "The quick brown fox, jumps.\nOver  it's 12345 lazy dogs!!", "naïve café – ünïcode", "tab\tand   spaces \n end "]
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    for r in token_counts.count_tokens(docs, path).collect():
        t = texts[r["doc_id"]] or ""
        assert (r["n_tokens"], r["n_bytes"]) == (count(t), len(t.encode()))
    stored = token_counts.prefix_counts(docs, path)
    for r in stored.collect():
        t = texts[r["doc_id"]] or ""
        step = max(1, len(t) // 150)
        assert r["prefix_tokens"][::step] == [count(t[:n]) for n in range(0, len(t) + 1, step)]
    for r in token_counts.budget(token_counts.truncate(stored, 7), F.lit(3)).collect():
        t = texts[r["doc_id"]] or ""
        assert r["cut_chars"] == max(n for n in range(min(len(t), 300) + 1) if count(t[:n]) <= 7)
        assert (r["cut_tokens"], r["tokens_used"]) == (count(t[: r["cut_chars"]]), count(t[:3]))


def test_prefixes_of_random_texts_and_of_a_long_word():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library, own, rng = Tokenizer.from_file(path), token_counts.PrefixCounter(path), random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'ll", "'s", "'re", "é", "日本", "𝒳", "9", "12", "!", "...", "<|", "\u2003", "\xa0", "don't", "\x1c", "\r\n", "x" * 30, "<|endoftext|>"]
    for _ in range(150):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert own.prefixes(t).tolist() == [len(library.encode(t[:n], add_special_tokens=False).ids) for n in range(len(t) + 1)]
    long = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    assert own.count(long) == len(library.encode(long, add_special_tokens=False).ids)


def test_counts_of_empty_tables_and_repeated_rows(spark):
    path = P.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None)], "doc_id long, text string")
    assert sorted(map(str, token_counts.count_tokens(docs, path, drop_text=True).collect())) == ["Row(doc_id=1, n_bytes=7, n_tokens=2)"] * 2 + ["Row(doc_id=None, n_bytes=0, n_tokens=0)"]
    assert token_counts.truncate(token_counts.prefix_counts(docs.limit(0), path), 3).collect() == []


# ------------------------------------------------------------ surrogates


def test_surrogates_keep_kind_and_differ(spark):
    texts = ["Write to ann.lee@mail.example.com or ANN.LEE@mail.example.com, ip 10.0.0.7", "ann.lee@mail.example.com again; card 4111 1111 1111 1111", "Dear Mrs. Anna Schmidt, Mr Schmidt called +1 (017) 555-7713", "token = \"0123456789abcdef0123456789abcdef\"", "clean text of 2024-01-02, v1.2.3 and 12 apples", "", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").withColumn("n_entities", F.lit("clash"))
    got = {r["doc_id"]: r for r in surrogates.replace_pii(docs, b"key").collect()}
    assert got[4]["text"] == texts[4] and got[5]["text"] == "" and got[6]["text"] is None
    assert [got[k]["n_entities"] for k in range(7)] == [3, 2, 3, 1, 0, 0, 0]
    mails = re.findall(r"\S+@\S+?\.com", got[0]["text"])
    assert len(set(mails)) == 2 and mails[0] in got[1]["text"] and mails[1].split("@")[0].isupper() and "ann.lee" not in got[1]["text"]
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", got[1]["text"])[0].replace(" ", "")
    assert surrogates._luhn(card) == 0 and card[0] == "4" and card != "4111111111111111"
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[2]["text"]) and "Schmidt" not in got[2]["text"]
    first, second = re.search(r"Mrs\. (\w+) (\w+),", got[2]["text"]), re.search(r"Mr (\w+)", got[2]["text"])
    assert first[2] == second[1] and first[1].endswith("a")
    assert re.search(r'"[0-9a-f]{32}"', got[3]["text"]) and "0123456789abcdef" not in got[3]["text"]
    other = surrogates.replace_pii(docs, b"other key").filter("doc_id = 1").first()["text"]
    assert other != got[1]["text"]


def test_surrogates_are_one_to_one():
    key = b"k"
    ips = [f"{a}.{b}.7.200" for a in range(10, 60) for b in range(1, 10)]
    assert len({surrogates.surrogate("ip", x, key) for x in ips}) == len(ips)
    phones = [f"55-{n:04d}" for n in range(0, 10000, 7)]
    assert len({surrogates.surrogate("phone", x, key) for x in phones}) == len(phones)


def test_collisions_try_again_by_both_ways(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"Mr {n} and Mr Zz") for k, n in enumerate(["Abel", "Bell", "Cole", "Dunn", "Ford", "Gray"])], "doc_id long, text string")
    assert surrogates.surrogate("name_m", "Abel", b"k", 1) != surrogates.surrogate("name_m", "Abel", b"k", 0)
    one = {r["doc_id"]: r["text"] for r in surrogates.replace_pii(docs, b"k").collect()}
    monkeypatch.setattr(surrogates, "SHARED_TRIES", -1)
    two = {r["doc_id"]: r["text"] for r in surrogates.replace_pii(docs, b"k").collect()}
    assert one == two and len(set(one.values())) == 6


def test_surrogates_of_repeated_rows_and_clashing_columns(spark, monkeypatch):
    mail, others = "ann.lee@mail.example.com", ["Mr \u0531\u0576\u056b", "Mr \u05d3\u05d5\u05d3"]
    texts = [f"write to {mail}", f"write to {mail}", None, "", "password: ********", *others, "Mr Schmidt and Mrs Schmidt", "x " * 200_000 + mail]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string").selectExpr("text", "doc_id", "'a' as row", "'b' as new", "'c' as body", "7 as n_entities", "'d' as e", "'f' as c0", "'g' as known", "'h' as at", "'i' as own")
    for limit in (50_000, -1):
        monkeypatch.setattr(surrogates, "SHARED_TRIES", limit)
        done = surrogates.replace_pii(docs, b"k")
        assert done.columns == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
        rows = done.collect()
        assert {(r["row"], r["new"], r["body"], r["e"], r["c0"], r["known"], r["at"], r["own"]) for r in rows} == {tuple("abcdfghi")}
        got = [r["text"] for r in rows]
        first = [t for t in got if t and t.startswith("write to")]
        assert len(first) == 2 and first[0] == first[1] and mail not in first[0] and None in got and "" in got and "password: ********" in got
        new = first[0].removeprefix("write to ")
        assert "x " * 200_000 + new in got and not set(others) & set(got)
        pair = next(t for t in got if t and " and Mrs " in t).split(" and Mrs ")
        assert pair[0].removeprefix("Mr ") == pair[1] != "Schmidt"
    assert surrogates.replace_pii(docs.limit(0), b"k").collect() == []


def test_surrogates_are_distinct_over_a_table(spark):
    rng = random.Random(7)
    made = {"email": [f"{a}{k}@ex{k % 9}.org" for k, a in enumerate("abcdefghij" * 30)], "ip": [f"10.{k % 250}.{k % 7}.{k}" for k in range(250)], "phone": [f"+1 (555) 555-{k:04d}" for k in range(300)]}
    docs = spark.createDataFrame([(k, f"see {e} now") for k, e in enumerate(x for l in made.values() for x in rng.sample(l, len(l)))], "doc_id long, text string")
    table = surrogates.surrogate_table(docs, b"key").collect()
    new, old = [r["surrogate"] for r in table], {r["entity"] for r in table}
    assert len(set(new)) == len(new) and not set(new) & old and len(old) > 800
    by_doc = {r["doc_id"]: r["text"] for r in surrogates.replace_pii(docs, b"key").collect()}
    given = {r["entity"]: r["surrogate"] for r in table}
    for r in docs.collect():
        assert by_doc[r["doc_id"]] == f"see {given[r['text'][4:-4]]} now"


def test_long_secrets_and_phone_groups_are_found_whole():
    key = "".join(random.Random(2).choices("abcdefXYZ019._-", k=303))
    jwt, digits = f"token={key}", "0123456789abcdef" * 10
    phones = ["+49 30 1234567", "030 12345678", "+49 170 1234567", "+1 5551234567", "+33 1 23 45 67 89", "06 12 34 56 78", "+1 (017) 555-7713", "+49 (0)30 1234567", "(030) 12345678", "1-800-555-0199", "+4915112345678"]
    for text, kind in [(jwt, "secret"), (digits, "hex"), *((p, "phone") for p in phones)]:
        found = [(k, f"a {text}, b"[a:b]) for a, b, k in surrogates.find_entities(f"a {text}, b")]
        assert found == [(kind, text.removeprefix("token="))], text
    assert [(a, b) for a, b, _ in surrogates.find_entities("+49.30.1234567.87654321")] == [(0, 14)]
    for text in ["2024-01-02", "01.02.2024", "1998-2003", "12 of 1 000 apples", "v1.2.3", "pages 100-120", "password: ********"]:
        assert surrogates.find_entities(text) == [], text
    long = "ab1" * 100_000
    for kind, text in [("secret", key), ("hex", digits), ("secret", long), ("hex", digits * 1000)]:
        new = surrogates.surrogate(kind, text, b"k")
        assert len(new) == len(text) and new != text and new != surrogates.surrogate(kind, text, b"k2")
        assert sum(x == y for x, y in zip(new, text, strict=True)) < len(text) / 2
    assert len({surrogates.surrogate("secret", long[:2000] + c, b"k") for c in "0123456789"}) == 10


def test_names_of_one_family_move_together(spark):
    texts = ["Mr Schmidt", "Mrs Schmidt", "Mr Hans Schmidt", "Frau Anna SCHMIDT", "г-н Иванов", "г-жа ИВАНОВ", "Mrs Łąż", "Mr Łąż"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"].split() for r in surrogates.replace_pii(docs, b"k").orderBy("doc_id").collect()]
    assert len({g[-1].lower() for g in got[:4]}) == 1 and got[3][-1].isupper() and got[3][1].endswith("a")
    assert got[4][-1].lower() == got[5][-1].lower() != "иванов" and got[6][-1] == got[7][-1] != "Łąż"


def test_crowded_shapes_come_to_an_end(spark, monkeypatch):
    import itertools

    def made(*letters):
        return {"".join(x).capitalize() for x in itertools.product(*letters)}

    names = sorted(made("bcdfgklm", "aeiouy", "bdfgklmnprstvxz") | made("bcdfgklm", "aeiouy", "bdfgklmn", "aeiou"))[:2000]
    ips = [".".join(x) for x in itertools.product("0123456789", repeat=4)]  # all of the shape
    texts = [f"{t} {n}" for n in names for t in ("Mr", "Mrs")] + ips + ["password: ********"]
    tables = []

    def counted(df, purpose, real=surrogates.written):
        tables.append(purpose)
        assert len(tables) < 30, "no end of tries"
        return real(df, purpose)

    monkeypatch.setattr(surrogates, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in surrogates.replace_pii(docs, b"k").orderBy("doc_id").collect()]
    men, women = [t.split()[1] for t in got[:4000:2]], [t.split()[1] for t in got[1:4000:2]]
    assert len(names) == 2000 and men == women and len(set(men)) == 2000 and not set(men) & set(names)
    assert len(set(got[4000:14000])) == 10_000 and not set(got[4000:14000]) & set(ips)


# ------------------------------------------------------------ pages


def test_pages(spark):
    prose = "Some long enough sentence with several words in it, so that it reads like prose. And one more follows it, to be long enough."
    frame = '<html><head><title>t</title><script>var x="</p>";</script></head><body><nav><a href=1>Home</a></nav>{}<footer>&copy; site</footer></body></html>'
    pages = [frame.format(f"<div class='ad'>Buy it now.</div><article><h1>Title {k}</h1><p><b>{prose}<br><p>{prose} &amp; more  {k}</p></article>") for k in range(60)]
    pages += [frame.format(f"<main><p>{prose}</p><div id='comments'><p>{prose} by a reader</p></div><form><label>Mail</label><button>Go</button></form></main><aside>{prose}</aside>"), "", None, "<p>unclosed <b", "no markup at all, but long enough to be a sentence of prose with quite a few words in it.", "<!-- only a comment"]
    table = spark.createDataFrame([(k, "u", h, "x") for k, h in enumerate(pages)], "page_id long, url string, html string, text string")
    weights = html_text.fit(table)
    got = {r["page_id"]: r["text"] for r in html_text.extract(table, weights).collect()}
    assert all(got[k] == f"Title {k}\n{prose}\n{prose} & more {k}" for k in range(60))
    assert got[60] == prose and got[61] == "" and got[62] == "" and got[65] == ""


def made_page(rng):
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    menu = "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(5))
    body = [sentence(5), *[" ".join(sentence(rng.randint(4, 14)) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(3, 8))]]
    inner = f"<h1>{body[0]}</h1>" + "".join(f"<p>{b}</p>" for b in body[1:])
    return f'<html><body><nav><ul>{menu}</ul></nav><div class="ad">{sentence(7)}</div><article>{inner}</article><footer>&copy; {word()}.example</footer></body></html>', "\n".join(body)


def test_training_makes_the_model():
    rng = random.Random(8)
    pages = [made_page(rng) for _ in range(90)]
    trained, untrained = html_text.train([s for s, _ in pages[:60]]), html_text.train([])

    def f1(weights, hide, grafts=False):
        both = right = 0
        for k, (source, want) in enumerate(pages[60:]):
            got = html_text.main_text(html_text.grafted(source, k % 3) if grafts else source, weights, hide)
            a, b = Counter(got.split()), Counter(want.split())
            both, right = both + sum(a.values()) + sum(b.values()), right + 2 * sum((a & b).values())
        return right / both

    for hide in ("", "marks", "names"):
        assert f1(trained, hide) > 0.98 and f1(trained, hide, grafts=True) > 0.97
    # where neither marks nor names tell, only what was learnt can
    assert f1(trained, "names") > f1(untrained, "names") + 0.01
    assert (html_text.train([s for s, _ in pages[:60]]) == trained).all()


def test_pages_of_empty_tables_repeated_rows_and_formulas(spark):
    source = "<article><h1>Head</h1><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be so. " + "Long text here. " * 30_000 + "</p></article>"
    pages = spark.createDataFrame([(1, source, "old"), (1, source, "old"), (None, None, "old")], "page_id long, html string, text string")
    weights = html_text.fit(pages.limit(0))
    assert html_text.extract(pages.limit(0), weights).collect() == []
    got = html_text.extract(pages, html_text.fit(pages)).select("page_id", "text").collect()
    want = "Head\nLet x=2 be so. " + ("Long text here. " * 30_000).strip()
    assert [r["text"] for r in got if r["page_id"] == 1] == [want] * 2 and [r["text"] for r in got if r["page_id"] is None] == [""]


def test_marginals_equal_enumeration():
    import itertools

    rng = random.Random(0)
    parent = [-1, 0, 0, 1, 1, 2]
    unary = [rng.uniform(-2, 2) for _ in parent]
    edges = (-1.0, -0.5, 0.7)
    weight = {}
    for y in itertools.product((0, 1), repeat=6):
        s = sum(u for u, v in zip(unary, y, strict=True) if v)
        for k in range(1, 6):
            s += (0.0, edges[0], edges[1], edges[2])[2 * y[parent[k]] + y[k]]
        weight[y] = math.exp(s)
    total = sum(weight.values())
    p, pairs = html_text.marginals(parent, unary, edges)
    for k in range(6):
        assert abs(p[k] - sum(w for y, w in weight.items() if y[k]) / total) < 1e-9
    assert abs(pairs[3][1] - sum(w for y, w in weight.items() if not y[1] and y[3]) / total) < 1e-9


@pytest.mark.parametrize("name", ["svg", "template", "iframe", "title"])
def test_unclosed_elements_swallow_nothing(name):
    w = html_text.train([])
    page = f"<html><body><article><p>A first paragraph of the text.</p><{name} class=x><path d='M0'/>gone<p>A second one &amp; more.</p><p>The <{name}/>third.</p></article></body></html>"
    assert html_text.main_text(page, w) == "A first paragraph of the text.\nA second one & more.\nThe third."
    closed = f"<article><p>A first paragraph of the text.</p><{name}><div>gone</div></{name}><p>A second one stays.</p><{name}>gone<p>A third one stays.</p></article>"
    assert html_text.main_text(closed, w) == "A first paragraph of the text.\nA second one stays.\nA third one stays."


def test_training_sample_is_bounded(spark):
    ids = spark.range(1_000_000).withColumnRenamed("id", "page_id")
    pages = ids.withColumn("html", F.when(F.col("page_id") % 50 == 0, F.concat(F.lit("<main>"), F.col("page_id").cast("string"))).when(F.col("page_id") % 50 == 1, F.repeat(F.lit("<article>"), 30)))
    got = html_text.sample(pages, max_pages=100, max_bytes=200)
    rows = got.collect()
    assert len(rows) == 100 and all(r["html"].startswith("<main>") for r in rows)
    assert sorted(rows) == sorted(html_text.sample(pages.repartition(7), max_pages=100, max_bytes=200).collect())
    assert html_text.sample(pages.limit(200), max_pages=100, max_bytes=200).count() == 4
