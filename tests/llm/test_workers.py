"""Workers whose path lacks the package run every query of this part that has Python functions."""

import os
import pathlib
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {repo!r})  # of the driver only: workers start with their own path, in another folder
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
def without(batches):
    import importlib.util
    if importlib.util.find_spec("tunemill"):
        raise ValueError("the package is on the workers' path")
    yield from batches
spark.range(1).mapInArrow(without, "id long").collect()
from tunemill.llm import pieces, secrets, tokens, toxicity, urls
text = ["token = 'abcdefgh%d' and an1diot!! otherwords%d xx" % (i, i) for i in range(60)]
docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
pages = spark.createDataFrame([(i, u + str(i)) for i, u in enumerate(
    ["http://a.com/x", "http://b.net/es/", "http://c.org/?q="] * 8)], "page_id long, url string")
print(secrets.found(docs).count(), toxicity.scored(docs, labels).count(), urls.judged(pages).count(),
      pieces.round_trip(docs).count(), tokens.token_counts(docs).count())
"""


def test_python_functions_travel_by_value(tmp_path):
    repo = str(pathlib.Path(__file__).resolve().parents[2])
    env = dict(os.environ)
    env["PYTHONPATH"] = os.pathsep.join(
        p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p and pathlib.Path(p).resolve() != pathlib.Path(repo))
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == ["60", "60", "24", "60", "60"]
