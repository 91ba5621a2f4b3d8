"""What the registered baseline is worth: accuracy and the larger class, on a table it can and one it cannot learn."""

import hashlib

import pytest

from sluice.plans import all_queries


def scores(spark, folder, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    made.write.parquet(f"{folder}/embeddings.parquet")
    return all_queries()["baseline_scores"].run(spark, str(folder)).first()


def test_rows(spark, tmp_path):
    # labels 0 to 9, three in ten below 5; the first component says which, the second nothing
    rows = [(i, [1.0 if i % 10 < 3 else -1.0, float(i % 7)], i % 10 if i % 10 < 3 else 5 + i % 5) for i in range(600)]
    test = [r for r in rows if int(hashlib.md5(str(r[0]).encode()).hexdigest()[:8], 16) % 100 >= 80]
    low = sum(r[2] < 5 for r in test) / len(test)
    told = scores(spark, tmp_path / "told", rows)
    assert (told.n_train, told.n_test) == (len(rows) - len(test), len(test))
    assert told.accuracy == 1.0 and told.larger_class == pytest.approx(max(low, 1 - low)) and told.larger_class < 1
    blind = scores(spark, tmp_path / "blind", [(i, [0.0, 0.0], label) for i, _, label in rows])
    assert blind.accuracy == pytest.approx(1 - low) == pytest.approx(blind.larger_class)
