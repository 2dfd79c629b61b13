import random
import re

import pytest

import corpus_pipeline as CP
from test_llm_decontaminate import brute as brute_passages
from test_llm_near_dedup import brute as brute_components
from test_llm_pii import brute as brute_spans
from talentmatch.llm.pii import KINDS

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted toxic documents, copies, benchmark passages and personal data."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(20)) for k in range(5)]
    docs, labels = [], []
    for i in range(500):
        toxic = i % 7 == 0
        t = text(rng.randint(20, 90))
        if toxic:
            t = " ".join(w + (" zorgul xukking" if rng.random() < 0.15 else "") for w in t.split()) + " zorgul"
        elif i % 11 == 0:
            words = items[i % 5][1].split()
            t += " " + " ".join(words[rng.randint(0, 8):]) + " " + text(3)
        elif i % 13 == 0:
            t += f" mail user{i}@mail.example.com or 10.1.2.{i % 256}"
        elif i % 5 == 0 and docs:
            words = rng.choice([d for d in docs if d[1]])[1].split()
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        docs.append((i, t, "en", f"s{i % 3}", len(t)))
        labels.append((i, 1, int("zorgul" in t)))
    docs += [(600, None, None, None, None), (601, "", "en", "s0", 0), (None, text(30), "en", None, 1), (None, text(30), "en", None, 1), docs[1], docs[1]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items


def rows(df):
    return sorted([tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()], key=str)


def test_every_stage_against_brute_force(spark, folder, tmp_path):
    sf, docs, items = folder
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    at = {}
    for name, stage in CP.STAGES:
        out = stage(spark, frame, sf)
        if name != CP.STAGES[-1][0]:
            assert out.schema.names == frame.schema.names
        out.write.parquet(str(tmp_path / name))
        at[name] = frame, (frame := spark.read.parquet(str(tmp_path / name)))

    before, after = (rows(x) for x in at["toxicity"])
    assert before == sorted(docs, key=str)
    assert after == [r for r in before if "zorgul" not in (r[1] or "")]

    before, after = (rows(x) for x in at["near duplicates"])
    named = brute_components([r[:2] for r in before if r[0] is not None], 5)
    assert after == sorted([r for k, r in enumerate(before) if r[0] is None or (named[r[0]][2] and r not in before[:k])], key=str)
    assert len(after) < len(before) - 20

    before, after = (rows(x) for x in at["benchmark decontamination"])
    hit = {x[0] for x in brute_passages([(k, r[1]) for k, r in enumerate(before)], items) if x[-1]}
    assert hit and after == [r for k, r in enumerate(before) if k not in hit]

    before, after = (rows(x) for x in at["personal data"])
    want = []
    for r in before:
        t = r[1]
        if t is not None:
            for kind, a, b in reversed(brute_spans(t)):
                t = t[:a] + f"[{KINDS[kind].upper()}]" + t[b:]
        want.append((r[0], t, r[2], r[3], None if t is None else len(t)))
    assert after == sorted(want, key=str) and any("[EMAIL]" in (r[1] or "") for r in after)

    before, got = rows(at["mixing"][0]), at["mixing"][1].collect()
    sizes = sorted((str(r[0]), len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in before)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sizes
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - 1.5 * sum(n for _, n in sizes)) < 0.03 * sum(n for _, n in sizes)


def test_run_is_all_stages(spark, folder):
    sf, _, _ = folder
    out = CP.run(spark, sf)
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"] and out.count() > 200


def test_empty_documents(spark, folder, tmp_path):
    sf, _, _ = folder
    frame = spark.createDataFrame([], DOCS)
    for _, stage in CP.STAGES:
        frame = stage(spark, frame, sf)
        assert frame.count() == 0


def test_columns_with_clashing_names_are_carried_along(spark, folder):
    from pyspark.sql import functions as F
    sf, docs, _ = folder
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["key", "KEY_", "id", "component_id", "h", "sid", "size", "rank", "segment", "n_words", "matches", "root"]
    wide = frame.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("text"), F.lit("none"))).alias(n) for n in names])
    for name, stage in CP.STAGES[:-1]:
        out, plain = stage(spark, wide, sf), stage(spark, frame, sf)
        assert out.columns == wide.columns
        assert rows(out) == rows(plain)
        if name != "personal data":     # there the text changes, the copies of it do not
            assert all(r[n] == f"{n} of {'none' if r['text'] is None else r['text']}" for r in out.collect() for n in names)
    name, stage = CP.STAGES[-1]
    assert sorted(map(tuple, stage(spark, wide, sf).collect()), key=str) == sorted(map(tuple, stage(spark, frame, sf).collect()), key=str)


def test_run_leaves_only_its_result_in_the_shared_folder(spark, folder):
    from talentmatch import session as S
    since = len(S._SCRATCH)
    out = CP.run(spark, folder[0])
    assert [p.split("/")[-1].rsplit("-", 1)[0] for p in S._SCRATCH[since:]] == ["mixing"] and out.count()


def test_long_documents_come_in_bounded_batches(spark, folder):
    import pyarrow as pa
    from talentmatch import session as S

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    docs = spark.range(0, 200, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 15000) AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    arrow = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        for name, stage in CP.STAGES:
            for key in S.DOCUMENT_DEFAULTS:
                spark.conf.unset(key)
            stage(spark, docs, folder[0])
            got = docs.mapInArrow(sizes, "n long, bytes long").collect()
            assert sum(r.n for r in got) == 200 and max(r.bytes for r in got) < 6 << 20, name
        spark.conf.set(arrow, "9m")
        S.bounded_batches(spark)
        assert spark.conf.get(arrow) == "9m"
    finally:
        for key in S.DOCUMENT_DEFAULTS:
            spark.conf.unset(key)
