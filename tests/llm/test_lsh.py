import numpy as np
import pytest

from faresettle.llm import catalog, lsh

SCHEMA = "vec_id long, embedding array<float>, label int, tab string, key string, weight string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def all_pairs(rows, least=0.98):
    """Links and components of (id, vector, label) by comparing all pairs."""
    usable = [v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    links, label = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                    links[i] += 1
                    links[j] += 1
                    label[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for k, row in enumerate(rows):
        smallest[find(k)] = min(smallest.get(find(k), row[0]), row[0])
    return [(row[0], links[k], smallest[find(k)]) for k, row in enumerate(rows)]


def clusters(count, width, noise, seed=0, families=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(families, width))
    return [(int(k), (centres[k % families] + rng.normal(size=width) * noise).astype(np.float32).tolist(), int(k % 2)) for k in range(count)]


def found(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect())


def recall(rows, out):
    there = sum(x[1] for x in all_pairs(rows))
    return sum(x[1] for x in out) / there if there else 1.0


def test_hadamard_is_orthogonal():
    rows = lsh.hadamard(np.eye(16))
    assert (rows @ rows.T == 16 * np.eye(16)).all()


def test_near_clusters(spark):
    rows = clusters(240, 64, 0.05)
    assert found(lsh.near_vectors(vectors(spark, rows))) == sorted(all_pairs(rows))


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold are the hardest; nothing below it is linked."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(1500):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = 0.9801 + 0.004 * rng.random()
        rows += [(2 * k, a.astype(np.float32).tolist(), 1), (2 * k + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).astype(np.float32).tolist(), 1)]
    for hashes in (2, 3):
        out = found(lsh.near_vectors(vectors(spark, rows), hashes=hashes))
        linked = sum(x[1] for x in out) / len(rows)
        assert 0.95 <= linked <= 1


def test_blocks_of_a_large_bucket_give_the_same(spark):
    rows = clusters(300, 32, 0.02, seed=3, families=2)
    df = vectors(spark, rows)
    assert found(lsh.near_vectors(df, bucket_block=16)) == found(lsh.near_vectors(df)) == sorted(all_pairs(rows))


def test_rows_of_every_kind(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, [2.0, 4.0, 6.0], 1), (4, one, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [0.0, -0.0, 0.0], 1),
        (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1), (10, [1.0, float("inf"), 3.0], 1), (11, [], 1), (12, [1.0, 2.0], 1), (13, [1.0, 2.0], 1),
        (14, [-1.0, -2.0, -3.0], 1), (15, one, 2), (16, [5.0], 3), (17, [6.0], 3), (18, [-6.0], 3), (19, [1e-38, 2e-38, 3e-38], 1), (20, [1e38, 2e38, 3e38], 1),
    ]
    assert found(lsh.near_vectors(vectors(spark, rows))) == sorted(all_pairs(rows))


def test_null_ids_and_no_rows(spark):
    out = lsh.near_vectors(vectors(spark, [(None, [1.0, 1.0], 1), (4, [1.0, 1.0], 1), (None, [1.0, -1.0], 1)]))
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in out.collect()) == [(-1, 0, -1, True), (-1, 1, 4, False), (4, 1, 4, True)]
    assert lsh.near_vectors(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_table_against_sql(spark, scale):
    from check_oracle import connect, difference

    directory = f"/root/testdata/sf{scale}"
    assert difference(catalog.op1_embedding_near_dedup(spark, directory).toPandas(), connect(directory).sql(catalog.NEAR_SQL).df()) is None


def test_table_recall(sf):
    df = sf("embeddings", "0.01")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    out = found(lsh.near_vectors(df))
    assert recall(rows, out) >= 0.99
    assert all(a[1] <= b[1] for a, b in zip(out, sorted(all_pairs(rows))))


@pytest.mark.parametrize("labels", [
    ("double", [0.2, 0.7, 0.2, -0.0, 0.0, float("nan"), float("nan"), None]),
    ("string", ["a", "b", "a", "", "", "1", "1", None]),
    ("array<int>", [[1], [2], [1], [], [], [3, 4], [3, 4], None]),
    ("date", ["2020-01-01", "2020-01-02", "2020-01-01", "1999-01-01", "1999-01-01", "2000-01-01", "2000-01-01", None]),
])
def test_labels_of_any_type_are_compared_as_they_are(spark, labels):
    kind, values = labels
    rows = [(k, [1.0, 2.0], str(v) if kind == "date" and v else v) for k, v in enumerate(values)]
    shown = "string" if kind == "date" else kind
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {shown}")
    frame = frame.withColumn("label", frame["label"].cast(kind))
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lsh.near_vectors(frame).collect()}
    assert out == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), 7: (0, 7)}
