"""The pipeline on a small planted corpus: every decision takes effect, clean documents stay."""
import weakref
import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from stratlab.llm.common import Scratch

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(21)
    item = prose(rng, 30)
    rows, labels = [], []

    def add(i, text, quality=None, toxic=None):
        rows.append((i, text, "en" if i is None or i % 2 else "fr", f"s{(i or 0) % 3}", len(text or "")))
        if quality is not None:
            labels.append((i, quality, toxic))

    for i in range(0, 300):
        add(i, prose(rng, rng.randint(30, 120)), 1, 0)
    for i in range(300, 380):
        words = prose(rng, 60).split()
        words[rng.randrange(60)] = rng.choice(["snotwort", "blockhead", "grumbleface"])
        add(i, " ".join(words), 1, 1)
    for i in range(380, 400):
        add(i, " ".join(w.upper() + "!!" for w in prose(rng, 50).split()), 0, 0)
    base = prose(rng, 150).split()
    for i in range(400, 410):
        v = base[:]
        v[rng.randrange(150)] = "other"
        add(i, " ".join(v if i > 400 else base))
    add(410, rows[5][1])
    add(411, prose(rng, 20) + " " + item + " " + prose(rng, 20))
    add(412, None)
    add(413, "")
    add(None, prose(rng, 40))
    rows.append(rows[7])
    folder = Scratch(spark, "pipeline-test").base
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, corpus):
    folder, rows = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    scratch = Scratch(spark, "pipeline-stages")
    for name, stage in P.STAGES:
        docs = scratch.write(stage(spark, docs, folder), name)
        seen[name] = [r.doc_id for r in docs.collect()]
        if name != "packing":
            assert tuple(docs.columns) == P.COLUMNS
    toxic = set(range(300, 380))
    assert len(toxic & set(seen["toxicity"])) <= 1 and len(set(range(300)) - set(seen["toxicity"])) <= 12  # a model of 300 texts
    assert not set(range(380, 400)) & set(seen["quality"]) and not {412, 413} & set(seen["quality"])
    assert set(seen["toxicity"]) - set(seen["quality"]) <= {*range(380, 400), 412, 413}
    kept = seen["near_duplicates"]
    assert sum(400 <= (d or 0) < 410 for d in kept) == 1 and 410 not in kept and 5 in kept
    assert kept.count(7) == 1 and None in kept
    assert set(seen["quality"]) - set(kept) <= {*range(400, 410), 410}
    assert set(kept) - set(seen["decontamination"]) == {411}
    assert set(seen["packing"]) == set(seen["decontamination"])


def test_run_is_the_last_stage(spark, corpus):
    folder, _ = corpus
    out = P.run(spark, folder)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(out.columns)
    assert out.where("offset + length > 2048").count() == 0


def test_registered():
    names = set(E.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}


def test_a_worker_holds_what_one_operator_needs():
    from stratlab.llm.common import worker_cache

    class Model:
        pass

    first, second = worker_cache("a:1", "model", Model), worker_cache("a:1", "words", Model)
    assert worker_cache("a:1", "model", Model) is first and worker_cache("a:1", "words", Model) is second
    gone = [weakref.ref(first), weakref.ref(second)]
    del first, second
    third = worker_cache("a:2", "model", Model)   # the model of a later call takes the place of the earlier
    assert [g() for g in gone] == [None, None]
    assert worker_cache("a:2", "model", Model) is third
