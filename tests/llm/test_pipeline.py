import random

import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.brute import docs_of
from tests.llm.test_contain import plain_shingles
from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_toxicity import LABELS, corpus
from tunemill.llm import lines, pieces, toxicity
from tunemill.llm.common import BATCH_BYTES
from tunemill.llm.pieces import Pieces, model_path


def tables(spark, folder):
    rng = random.Random(9)
    rows, labels = corpus(4, 90)
    items = [" ".join(f"item{i}word{k}" for k in range(30)) for i in range(4)]
    clean = [t for i, t in rows if i % 5]
    more = [clean[0], clean[1] + " end", "start " + clean[2] + "\n" + clean[3], items[0], clean[5] + ". " + items[1].upper(),
            clean[6] + "\n" + " ".join(items[2].split()[:28]), None, "", "short one"]
    rows += [(1000 + i, t) for i, t in enumerate(more)] + [(None, "no id " + " ".join(rng.choices("abcdefg", k=30))), (7, rows[7][1])]
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).drop("text").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def plain_stages(rows, items):
    """Rows of id and text after the three middle stages."""
    gone = {}
    for doc, line in plain_lines(rows, 0.8):
        gone.setdefault(doc, set()).add(line)
    cut = []
    for doc, text in rows:
        left = text if doc not in gone or not text else "\n".join(
            x for k, x in enumerate(text.split("\n")) if k not in gone[doc])
        if doc not in gone or left.split():
            cut.append((doc, left))
    yield cut
    pairs = [(doc, plain_fingerprint(text)) for doc, text in cut]
    later = {doc for (doc, _), c in zip(pairs, plain_components(pairs)) if doc is not None and doc != c}
    cut = [(d, t) for d, t in cut if d not in later]
    yield cut
    needs = [plain_shingles(i) for i in items]
    leaked = {d for d, t in cut if any(len(n & plain_shingles(t)) >= 0.8 * len(n) for n in needs)}
    yield [(d, t) for d, t in cut if d is None or d not in leaked]


def test_pipeline_equals_brute_force(spark, tmp_path):
    items = tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    result = corpus_pipeline.toxicity_stage(spark, docs, str(tmp_path))
    assert result.columns == columns
    rows = [(r.doc_id, r.text) for r in result.collect()]
    bad = {i for i in range(90) if i % 5 == 0}
    assert len(bad & {d for d, _ in rows}) <= 3 and len({d for d, _ in rows} - bad) >= 75
    result = result.coalesce(4)
    result.write.parquet(f"{tmp_path}/step0")
    docs = spark.read.parquet(f"{tmp_path}/step0")
    for k, ((_, stage), want) in enumerate(zip(corpus_pipeline.STAGES[1:4], plain_stages(rows, items)), 1):
        result = stage(spark, docs, str(tmp_path))
        assert result.columns == columns
        result.write.parquet(f"{tmp_path}/step{k}")
        docs = spark.read.parquet(f"{tmp_path}/step{k}")
        assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == sorted(want, key=repr)
    model = Pieces(model_path())
    last = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert len(last) == len(want) and all(r.round_trip for r in last)
    texts = dict(want)
    for r in last:
        if texts[r.doc_id] is not None and r.doc_id is not None:
            assert b"".join(model.text[i] for i in r.ids) == (b" " if r.ids else b"") + texts[r.doc_id].encode()
    assert sorted(map(repr, (r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()))) == sorted(
        map(repr, (d for d, _ in want)))


@pytest.mark.parametrize("stage, module, name", [
    ("toxicity", toxicity, "scored"), ("line", lines, "clean"), ("encoding", pieces, "round_trip")])
def test_stages_give_python_tasks_few_megabytes_at_a_time(spark, tmp_path, monkeypatch, stage, module, name):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes]), pa.array([0])],
                                             ["doc_id", "text", "predicted"])

    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('a word ', 500) AS text")
    monkeypatch.setattr(module, name, lambda d, *_, **__: d.mapInArrow(sizes, "doc_id long, text long, predicted long"))
    spark.conf.unset(bound)
    try:
        found = getattr(corpus_pipeline, f"{stage}_stage")(spark, docs, str(tmp_path)).collect()
        assert sum(r[0] for r in found) == 4000 and max(r[1] for r in found) < 1.5 * BATCH_BYTES
        spark.conf.set(bound, str(1 << 20))  # a session's own bound stays
        corpus_pipeline.encoding_stage(spark, docs, str(tmp_path))
        assert spark.conf.get(bound) == str(1 << 20)
    finally:
        spark.conf.unset(bound)
