"""Array files read by byte ranges against the whole-file reader."""

import json
import os
import random

import pytest

from tierflow.sources import large_arrays
from tierflow.sources.landing import read_json_documents
from tierflow.sources.large_arrays import read_large_arrays


def write(folder, texts):
    for i, text in enumerate(texts):
        with open(os.path.join(folder, f"{i:03d}.json"), "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    return folder


def rows(df):
    return sorted((tuple(r) for r in df.select("path", "doc_is_array", "doc_size", "raw_json").collect()), key=str)


@pytest.fixture
def small_splits(spark, monkeypatch):
    """Ranges of a few hundred bytes and chunks of a few pieces."""
    monkeypatch.setattr(large_arrays, "CHUNK", 3)
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "a", "é", "\n", "\\\\", '\\"', "🙂", " "]) for _ in range(rng.randrange(12)))
    if kind < 5:
        return rng.choice([None, True, 1.0, -5, 1e300, 0.1, 12345678901234567890])
    if kind < 7:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {value(rng, 9) if isinstance(value(rng, 9), str) else f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(4))}


def test_like_the_whole_file_reader(spark, tmp_dir, small_splits):
    rng = random.Random(4)
    texts = []
    for i in range(25):
        doc = [value(rng) if rng.random() < 0.3 else {f"k{j}": value(rng, 1) for j in range(rng.randrange(4))} for _ in range(rng.choice([0, 1, 3, 30]))]
        texts.append(json.dumps(doc, ensure_ascii=i % 2 == 0, indent=[None, 1, "\t"][i % 3]) + ["", "\n", " \r\n"][i % 3])
    folder = write(tmp_dir, texts)
    want = rows(read_json_documents(spark, folder))
    assert rows(read_large_arrays(spark, folder)) == want
    assert len(want) > 150 and {r[1] for r in want} == {True}


BROKEN = [
    "", " ", "null", "5", "{}", '{"a":[1]}', "[", "]", "[]]", "[[]", "[1,]", "[,1]", "[1][2]", "[1],[2]", "[1] x", '[{"a":1}', '[{"a":1}]}', '[{"a":1},]', '[{"a":1} {"b":2}]', '[{"a":1},,{"b":2}]',
    '[{"a":1}],[{"b":2}]', '[{"a":1}][{"b":2}]', '{"a":1}]', '[{"a":"}]', '[{"a":1}}]', '[{"a":1]}', '["\\}"]', '[{"a":1}],"mark":["k"]},{"z":[2]', '[{"a":1}],"x":[{"b":2}]', '[{"a":1}] {"b":2}', '[{"a":1},{"b":}]', "[{]}",
]
SOUND = ["[]", " [ ] \n", "[1]", "[null, null]", '["}", "{", "]"]', '[{}]', '[{},{}]', '[[{}],{"a":"\\\\"},"\\"}"]', '\n[\n{"a":\n{"b":"}"}}\t,null,3 ]\n', "[[[]]]", '[{"a":[{"b":[{}]}]}, "x", []]']


def test_other_documents(spark, tmp_dir, small_splits):
    folder = write(tmp_dir, BROKEN + SOUND)
    got = rows(read_large_arrays(spark, folder))
    assert got == rows(read_json_documents(spark, folder))
    assert sum(not r[1] for r in got) == len(BROKEN) - 1  # Spark's readers skip a file without bytes


def test_one_file_by_many_tasks(spark, tmp_dir, small_splits):
    doc = [{"id": i, "text": '"}],[{\\' * (i % 5), "more": {"n": [i, {"m": "}"}]}} for i in range(400)]
    folder = write(tmp_dir, [json.dumps(doc)])
    pieces = large_arrays._pieces(spark, [folder])
    assert pieces.rdd.getNumPartitions() > 50
    got = [json.loads(r.raw_json) for r in read_large_arrays(spark, folder).collect()]
    assert sorted(got, key=lambda r: r["id"]) == doc


def test_plan_moves_the_text_once(spark, tmp_dir):
    folder = write(tmp_dir, ['[{"a":1}]'])
    df = read_large_arrays(spark, folder)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
