"""The pipeline's rows against plain versions of its stages."""

import re

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from ledgerline.llm import bpe, quality

from . import brute
from .test_quality import LABELS, corpus
from .test_secrets import TEXTS, plain

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_equals_plain_stages(spark, tmp_path):
    rows, labels = corpus(n=250)
    rows = [r[:5] for r in rows]
    rows += [(1000 + i, r[1] + " tail", *r[2:]) for i, r in enumerate(rows[:20])] + [(2000 + i, " ".join(r[1].split()[::-1]) + " " + (t or ""), *r[2:]) for i, (r, t) in enumerate(zip(rows[30:], TEXTS, strict=False))]
    rows += [(None, rows[40][1], "en", None, None), (3000, None, None, None, None), rows[3]]
    items = [(1, " ".join(rows[60][1].split()[5:30])), (2, " ".join(rows[61][1].split()[5:9]))]
    frame, label_frame = spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(labels, LABELS)
    for name, df in (("documents", frame), ("labels", label_frame), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*frame.columns, "token_ids", "n_tokens"]

    keep = {(r.doc_id): r.keep for r in quality.assess(frame, label_frame).collect()}
    left = [r for r in rows if keep[r[0]]]
    sets = [brute.shingles(r[1]) for r in left]
    pairs = [(a, b) for a in range(len(left)) for b in range(a + 1, len(left)) if brute.jaccard(sets[a], sets[b]) >= 0.8]
    group, seen, stay = brute.roots(len(left), pairs), set(), []
    for r, g in zip(left, group, strict=True):
        least = min((left[j][0] for j in range(len(left)) if group[j] == g and left[j][0] is not None), default=None)
        if r[0] is None or r[0] == least and r[0] not in seen:
            seen.add(r[0])
            stay.append(r)
    windows = set()
    for _, text in items:
        w = brute.words9(text)
        windows |= {" ".join(w[i : i + min(10, len(w))]) for i in range(len(w) - min(10, len(w)) + 1)}
    stay = [r for r in stay if not any(f" {x} " in f" {' '.join(brute.words9(r[1]))} " for x in windows)]
    assert 0 < len(stay) < len(left) < len(rows)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_ranks()), special_tokens={})
    want = []
    for r in stay:
        inside = {i for s, _, e, _ in plain(r[1]) for i in range(s, e)}
        text = "".join("" if i in inside and i - 1 in inside else "[secret]" if i in inside else c for i, c in enumerate(r[1]))
        want.append((str(r[0]), text, r[2], r[3], r[4], coder.encode_ordinary(text)))
    got = [(str(r.doc_id), r.text, r.lang, r.source, r.n_chars, list(r.token_ids)) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(re.search(r"\[secret\]", x[1]) for x in got)
    assert np.all([r.n_tokens == len(r.token_ids) for r in out.collect()])
