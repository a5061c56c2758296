"""The pipeline on a small odd input: every stage against a plain version of it."""

import random
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from seqframe.llm import mixing, quality
from test_neardup import bag, jaccard
from test_texts import brute_leaks

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    good = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(5)) + "."
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(40))
    exam = " ".join(word() for _ in range(14))
    rows = [(k, good() if k % 3 else bad(), ["a", "b", None][k % 5 % 3]) for k in range(150)]
    rows += [(200 + k, t + (" Tail." if k % 2 else ""), s) for k, (_, t, s) in enumerate(rows[:40])]  # copies
    rows += [(300, f"{good()} {exam} {good()}", "a"), (301, None, "a"), (302, "", "b"), (None, good(), "c"), rows[7], rows[7]]
    where = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("doc_id", "text", "'en' as lang", "source", "length(text) as n_chars").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, exam), (2, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def test_every_stage(spark, folder, tmp_path, monkeypatch):
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: fit(*a, **k | {"updates": 1500}))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "token_store":
            assert after.columns == docs.columns
        seen[name] = (before, docs, after)
        docs = after
    rows = lambda df: sorted(((r["doc_id"], r["text"], r["source"]) for r in df.collect()), key=repr)

    before, source, after = seen["quality"]
    weights = quality.fit(source, spark.read.parquet(f"{folder}/labels.parquet"), quality.crc("doc_id", 5) != 0)
    assert rows(after) == rows(quality.score(source, weights).filter(F.col("score") >= corpus_pipeline.KEEP_SCORE))
    kept = {r["doc_id"] for r in after.collect()}
    held = [k for k in range(150) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((k in kept) == (k % 3 > 0) for k in held)

    before, _, after = seen["near_duplicates"]
    left, groups = rows(after), []
    for row in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = bag(row[1])
        near = [g for g in groups if own and any(jaccard(own, bag(t)) >= 0.8 for _, t, _ in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [row]]
    assert len(left) == len(groups)
    for g in groups:
        assert len([r for r in left if r in g]) == 1

    before, _, after = seen["decontaminate"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [r for r in before if not brute_leaks(r[1], items)[3]]
    assert rows(after) == sorted(clean, key=repr) and len(clean) == len(before) - 1

    before, source, after = seen["mix"]
    plan = mixing.plan_copies(source, mixing.words("text")).select("row.doc_id", "row.text", "row.source", "copies").collect()
    assert rows(after) == sorted([(r["doc_id"], r["text"], r["source"]) for r in plan for _ in range(r["copies"])], key=repr)

    before, _, after = seen["token_store"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    start = 0
    want = []
    for k, t, _ in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((k, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in after.collect()), key=repr) == sorted(want, key=repr)


def test_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, folder)
        assert out.collect() == []
