import re

import numpy as np
import pytest

from ledgerline.llm import lsm_dedup

from . import brute


def plain(rows, window=13):
    words = [re.findall("[^\x20\x09-\x0d]+", r[1] or "") for r in rows]
    least = {}
    for r, w in zip(rows, words, strict=True):
        if r[0] is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                least[key] = min(least.get(key, r[0]), r[0])
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = {k for i in range(len(w) - window + 1) if r[0] is not None and least[tuple(w[i : i + window])] < r[0] for k in range(i, i + window)}
        out.append((str(r[0]), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize(("batches", "slices"), [(1, 1), (5, 2)])
def test_equals_brute_force(spark, batches, slices):
    rows = [*brute.documents(), (None, brute.documents()[5][1], None, None, None, "", ""), (-5, brute.documents()[12][1], None, None, None, "", "")]
    out = lsm_dedup.deduplicate(spark.createDataFrame(rows, brute.SCHEMA).repartition(3), batches=batches, slices=slices)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in out.collect())
    assert got == plain(rows)
    assert sum(x[2] for x in got) > 100


def test_index_is_compacted_and_resumes(spark):
    frame = spark.createDataFrame(brute.documents(), brute.SCHEMA)
    index, ages = lsm_dedup.Index(spark, buckets=8), []
    for part in lsm_dedup.batches_of(frame, 6):
        manifest = index.manifest()
        index.close()
        index = lsm_dedup.Index(spark, **manifest)
        index.add(part, 4)
        ages.append([age for _, age in index.runs])
    assert ages == [[1], [2], [2, 1], [4], [4, 1], [4, 2]]
    hashes = [h for r in index.history().collect() for h in zip(*(x.tolist() for x in lsm_dedup.unpack(bytes(r.a), bytes(r.b))), strict=True)]
    words = {tuple(w[i : i + 13]) for r in brute.documents() for w in [re.findall("[^\x20\x09-\x0d]+", r[1] or "")] for i in range(len(w) - 12)}
    assert len(hashes) == len(set(hashes)) == len(words)
    before = index.manifest()
    assert index.add(frame, 4, keep=False).count() > 0 and index.manifest() == before
    plan = spark._jvm.PythonSQLUtils.explainString(index.history().groupBy("key").count()._jdf.queryExecution(), "simple")
    assert "Bucketed: true" in plan and "Exchange" not in plan
    index.drop()


def test_packing_and_second_hash():
    one = np.array([1, 1, 5, 2**63], np.uint64)
    two = np.array([3, 9, 1, 1], np.uint32)
    assert [x.tolist() for x in lsm_dedup.unpack(*lsm_dedup.pack(one, two))] == [one.tolist(), two.tolist()]
    small = one[:3]
    assert [x.tolist() for x in lsm_dedup.unpack(*lsm_dedup.pack(small, two[:3]))] == [small.tolist(), [3, 9, 1]]
    asked = np.array([1, 1, 1, 5, 6], np.uint64), np.array([9, 3, 4, 2, 1], np.uint32)
    assert lsm_dedup.held_by((one, two), *asked).tolist() == [True, True, False, False, False]


def test_empty(spark):
    assert lsm_dedup.deduplicate(spark.createDataFrame([], brute.SCHEMA)).count() == 0
