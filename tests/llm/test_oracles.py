"""The registered SQL against the registered queries on small tables with odd rows."""

import random

import duckdb
import pytest

from larkspire.llm import queries as Q
from tests.llm.helpers import DOCS

WORDS = "the of Bob 12 kg apples, went and. a to 3.5kg Eve ran! 7 km far été Über 1st $5 (x) -- it's 40% Ana: be or no so up we if in on".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    random.seed(21)
    folder = str(tmp_path_factory.mktemp("tables"))
    make = lambda n: " ".join(random.choice(WORDS) for _ in range(n))
    bench = [make(random.randrange(1, 14)) for _ in range(30)]
    texts = [make(random.randrange(60)) + "\n" + random.choice(["Common line", "", "rare " + make(3)]) for _ in range(120)]
    texts += [f"{make(5)} {random.choice(bench)} {make(4)}" for _ in range(60)]
    texts += [t.replace("Bob", "Zed").replace("12", "15") for t in texts[120:150]]
    texts += [t + " tail" for t in texts[:30]] + texts[:15] + [None, "", " ", "one"]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    vectors = [[random.choice([-1.0, 0.5, 2.0]) for _ in range(6)] for _ in range(150)]
    spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_rows(spark, tables, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    found = db.execute(Q.oracle_sql()[name])
    columns = sorted(d[0] for d in found.description)
    want = sorted((tuple(dict(zip([d[0] for d in found.description], r))[c] for c in columns) for r in found.fetchall()), key=repr)
    df = Q.queries()[name](spark, tables)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want
    assert want
