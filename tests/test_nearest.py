import numpy as np
import pytest

from shelfmark.operators import nearest
from shelfmark.operators.ranking import semantic_topk

TABLE = "id long, embedding array<float>"


def same(spark, table, folder, query, count):
    pruned = nearest.semantic_topk_pruned(spark, folder, query, count)
    whole = semantic_topk(table, query, count)
    def rows(frame):
        return [(r["id"], "nan" if np.isnan(r["distance"]) else r["distance"]) for r in frame.orderBy("rank").collect()]
    assert rows(pruned.rows) == rows(whole)
    return pruned.read / pruned.stored


def test_clustered_vectors_are_pruned_and_exact(spark, tmp_path):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 16))
    vectors = np.repeat(centres, 50, axis=0) + 0.05 * rng.standard_normal((2000, 16))
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(vectors)] + [(5000 + i, [float(v) for v in vectors[7]]) for i in range(700)]
    table = spark.createDataFrame(rows, TABLE).repartition(6)
    nearest.write_groups(table, str(tmp_path / "g"), pivots=120)
    shares = [same(spark, table, str(tmp_path / "g"), [float(v) for v in q], k)
              for q, k in ((vectors[120], 10), (vectors[7], 30), (-vectors[900], 5), (centres[5] + centres[6], 60))]
    assert shares[0] < 0.1 and shares[1] < 0.5


def test_vectors_without_clusters_are_exact(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.standard_normal(24)]) for i in range(800)]
    table = spark.createDataFrame(rows, TABLE)
    nearest.write_groups(table, str(tmp_path / "g"), pivots=20)
    for k in (1, 7, 800, 2000):
        same(spark, table, str(tmp_path / "g"), rows[4][1], k)


def test_edge_cases(spark, tmp_path):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [-1.0, 0.0]), (6, [0.0, 2.0])]
    table = spark.createDataFrame(rows, TABLE)
    nearest.write_groups(table, str(tmp_path / "g"), pivots=2)
    for k in (0, 1, 2, 3, 4, 5, 9):
        same(spark, table, str(tmp_path / "g"), [1.0, 0.5], k)
    same(spark, table, str(tmp_path / "g"), [0.0, 0.0], 3)
    with pytest.raises(ValueError):
        nearest.semantic_topk_pruned(spark, str(tmp_path / "g"), [1.0, 0.0, 0.0], 2)
    nearest.write_groups(table.where("id = 2"), str(tmp_path / "none"))
    assert nearest.semantic_topk_pruned(spark, str(tmp_path / "none"), [1.0, 0.0], 3).rows.count() == 0
