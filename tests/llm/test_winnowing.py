import pytest

from ledgerline.llm import winnowing

from . import brute


def expected(rows, items):
    windows = set()
    for item, text in items:
        w = brute.words9(text)
        if item is not None and w:
            size = min(10, len(w))
            windows |= {(item, tuple(w[i : i + size])) for i in range(len(w) - size + 1)}
    out = []
    for r in rows:
        w, hit, found = brute.words9(r[1]), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= {*range(i, i + len(window))}
                    found.add(str(item))
        out.append((r[0], len(w), len(hit), len(found), brute.sha(",".join(sorted(found))), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_equals_brute_force(spark, limit):
    rows = brute.documents(60)
    some = [r[1] for r in rows if r[1] and len(r[1].split()) > 40]
    items = [(1, some[0][:300]), (2, " ".join(some[1].upper().split()[5:13])), (10, " ".join(some[2].split()[3:6])), (3, None), (4, ""), (None, some[3]), (2, some[4][50:200]), (5, "one"), (6, some[0][:300])]
    frame, bench = spark.createDataFrame(rows, brute.SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    out = winnowing.contamination(frame, bench, broadcast_bytes=limit)
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect())
    assert got == expected(rows, items)
    assert any(x[5] for x in got) and not all(x[5] for x in got)
    left = winnowing.clean(frame, bench, broadcast_bytes=limit)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(x[0] for x in got if not x[5])


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_empty(spark, limit):
    frame, bench = spark.createDataFrame(brute.documents(20), brute.SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert winnowing.contamination(frame, bench, broadcast_bytes=limit).where("contaminated").count() == 0
    assert winnowing.contamination(frame.limit(0), bench, broadcast_bytes=limit).count() == 0
