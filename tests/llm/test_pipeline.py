"""The pipeline against plain versions of its stages, on rows with nulls, repeats, empty and long texts and clashing columns."""

import hashlib
import random

import numpy as np

import corpus_pipeline
from kwloom.llm import pii, toxicity

from .test_nearcopies import kept_ids
from .test_tokens import ids_of
from .test_winnow import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _score string, N_TOKENS int"


def table():
    r = random.Random(8)
    text = lambda n: " ".join(f"w{r.randint(0, 3000)}" for _ in range(n))
    texts = [text(60) for _ in range(60)]
    texts += [t + " scum idiot scum" for t in texts[:20]]
    near = texts[30].split()
    near[5] = "changed"
    texts += [" ".join(near), texts[31], texts[32].upper(), "the passage " + " ".join("abcdefghijklm") + " ends", "mail a.b@c.example.com or 10.0.0.1", text(30_000), None, "", " \n "]
    rows = [(i, t, "en", "src", len(t) if t else 0, "clash", 7) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "a text without an id", "en", "src", 20, "clash", 7), (None, "the passage " + " ".join("abcdefghijklm"), None, None, 0, None, None)]
    return rows


def test_stages_match_plain_versions(spark, tmp_path):
    path = f"file://{tmp_path}"
    r = random.Random(3)
    rows = table()
    bad = lambda t: t is not None and "scum" in t
    marked = [(1000 + i, " ".join(f"w{r.randint(0, 3000)}" for _ in range(40)) + " scum idiot scum" * (i % 5 == 0), "en", "src", 0, "x", 0) for i in range(800)]
    spark.createDataFrame([*rows, *marked], SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(x[0], 1, int(bad(x[1]))) for x in marked]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    bench = [(1, " ".join("abcdefghijklm")), (2, None), (3, "")]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    everything = sorted(map(str, (tuple(x) for x in docs.collect())))
    assert len(everything) == len(rows) + len(marked)

    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "tokens":
            assert out.columns == columns, name
            out.write.parquet(f"{path}/{name}")
            before, docs = docs, spark.read.parquet(f"{path}/{name}")
            kept[name] = [tuple(x) for x in docs.collect()]
            if name == "toxicity":
                scored = toxicity.toxicity(before, spark.read.parquet(f"{path}/labels.parquet"))
                low = {str(x.doc_id) for x in scored.filter("predicted = 0").collect()}
                assert {str(i) for i, t, *_ in kept[name] if t and t.strip()} <= low
                assert not any(bad(t) for _, t, *_ in kept[name]) and {x[0] for x in rows if not bad(x[1])} <= {x[0] for x in kept[name]}
        else:
            last = out.collect()
    # one document of each class of near copies: by the smallest id, a null id after all others
    order = {}
    for x in sorted(kept["toxicity"], key=lambda x: (x[0] is None, x[0] or 0, str(x[1]))):
        order.setdefault((x[0], x[1]), len(order))
    first = kept_ids([(place, t) for (_, t), place in order.items()])
    assert sorted(str((x[0], x[1])) for x in kept["near_duplicates"]) == sorted(str(k) for k, place in order.items() if place in set(first))
    assert sorted(str(x[:2]) for x in kept["decontamination"]) == sorted(str(x[:2]) for x in kept["near_duplicates"] if not brute(x[1], bench)[4])
    assert not any("abcdefghijklm"[0] + " b c d" in (x[1] or "") for x in kept["decontamination"])
    masked = {(x[0], x[2], x[3]): x for x in kept["personal_data"]}
    assert len(kept["personal_data"]) == len(kept["decontamination"]) and len(masked) > 1
    for x in kept["decontamination"]:
        if pii.base_spans(x[1]):
            assert pii.base_spans(next(y[1] for y in kept["personal_data"] if y[0] == x[0])) == []
    assert len(last) == len(kept["personal_data"])
    want = sorted((str(x[0]), len(ids_of(x[1])), hashlib.sha256(ids_of(x[1]).tobytes()).hexdigest(), hashlib.sha256((x[1] or "").encode()).hexdigest()) for x in kept["personal_data"])
    assert sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in last) == want
    assert sum(x.n_tokens for x in corpus_pipeline.run(spark, path).collect()) == sum(x[1] for x in want) == np.sum([x.n_tokens for x in last])


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
