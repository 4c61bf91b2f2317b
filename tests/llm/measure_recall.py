"""Recall of the open neighbour search against brute force: python tests/llm/measure_recall.py FOLDER [GROW [QUERIES]]

With GROW, the usable vectors of FOLDER are the model of GROW times as many
new ones: a mixture of Gaussians, one for each of 24 territories, each with
the mean and covariance of its vectors.
"""

import sys
import tempfile
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

sys.path.insert(0, str(Path(__file__).parents[2]))


def usable_rows(folder: str) -> tuple[np.ndarray, list[str], np.ndarray]:
    t = pq.read_table(f"{folder}/vectors.parquet", columns=["vector_ordinal", "document_id", "vector"]).to_pylist()
    keep = [r for r in t if r["document_id"] is not None and r["vector"] is not None and len(r["vector"]) == 96 and all(x is not None and np.isfinite(x) for x in r["vector"]) and any(r["vector"])]
    x = np.array([r["vector"] for r in keep], np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), [r["document_id"] for r in keep], np.array([r["vector_ordinal"] for r in keep])


def grown(x: np.ndarray, times: int) -> np.ndarray:
    from vestigo.llm.neighbours import train_centroids

    rng = np.random.default_rng(5)
    at = np.argmax(x @ train_centroids(x[rng.choice(len(x), min(len(x), 16_000), replace=False)], 24).T, axis=1)
    parts = [rng.multivariate_normal(x[at == t].mean(0), np.cov(x[at == t].T), int((at == t).sum()) * times).astype(np.float32) for t in np.unique(at) if (at == t).sum() > 200]
    y = np.concatenate(parts)
    y = y[rng.permutation(len(y))]
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def main() -> None:
    from pyspark.sql import functions as F

    from vestigo.llm.neighbours import most_similar
    from vestigo.session import build_session

    x, ids, ordinals = usable_rows(sys.argv[1])
    times, n_queries = int(sys.argv[2]) if len(sys.argv) > 2 else 1, int(sys.argv[3]) if len(sys.argv) > 3 else 300
    if times > 1:
        x = grown(x, times)
        ids, ordinals = [f"d{i:09d}" for i in range(len(x))], np.arange(len(x))
    asked = np.flatnonzero(ordinals % 100 == 0)[:n_queries]
    true = []
    for lo in range(0, len(asked), 50):
        part = asked[lo : lo + 50]
        s = x[part] @ x.T
        s[np.arange(len(part)), part] = -9
        for row, got in zip(part, np.argpartition(-s, 40, axis=1)[:, :40]):
            best = {}
            for j in sorted(got, key=lambda j: -float(x[row] @ x[j])):
                if ids[j] != ids[row]:
                    best.setdefault(ids[j], float(x[row] @ x[j]))
            true.append((ids[row], sorted(best.items(), key=lambda b: -b[1])[:10]))
    folder = tempfile.mkdtemp(dir="/tmp")
    flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * 96, pa.array(x.ravel()))
    pq.write_table(pa.table({"vector_ordinal": ordinals, "document_id": ids, "vector": flat}), f"{folder}/vectors.parquet", row_group_size=50_000)
    spark = build_session(8, memory="12g")
    t = time.time()
    v = spark.read.parquet(f"{folder}/vectors.parquet")
    last = int(ordinals[asked[-1]])
    if times == 1:
        v = v.repartition(8)
    found = most_similar(v, queries=(F.col("vector_ordinal") % 100 == 0)).where(F.col("document_id_a").isin([a for a, _ in true])).collect()
    got: dict[str, dict[str, float]] = {}
    for r in found:
        got.setdefault(r.document_id_a, {})[r.document_id_b] = r.similarity
    hits = sum(len({b for b, _ in best} & set(got.get(a, ()))) for a, best in true)
    total = sum(len(best) for _, best in true)
    print(f"{len(x)} vectors, {len(true)} queries up to ordinal {last}: recall {hits / total:.4f}, {time.time() - t:.0f} s")


if __name__ == "__main__":
    main()
