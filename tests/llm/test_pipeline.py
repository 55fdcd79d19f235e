"""The stages one after another: each works on all that the one before kept."""

import __spark_entry__ as E
import corpus_pipeline as cp
from tessera.llm import mixing, secrets, toxicity
from tests.conftest import SF001
from tests.llm.test_near_dedup import brute
from tests.llm.test_packing import check


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, seen[-1], SF001).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
        if name != "packing":
            assert seen[-1].columns == columns
    rows = [{r.doc_id: r for r in df.collect()} for df in seen[:5]]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    kept = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").select("doc_id").collect()}
    assert set(rows[1]) == kept < set(rows[0])
    group = brute([(r.doc_id, r.text) for r in rows[1].values()])
    assert set(rows[2]) == {i for i, (_, c) in group.items() if i == c} < set(rows[1])
    assert {i: (r.text, r.n_chars) for i, r in rows[3].items()} == {
        i: (t := secrets.mask(r.text, "[SECRET]"), len(t)) for i, r in rows[2].items()}
    times = {r.doc_id: round(r.taken / max(r["size"], 1)) for r in mixing.taken(seen[3]).collect()}
    got = {r.doc_id: r["count"] for r in seen[4].groupBy("doc_id").count().collect()}
    assert got == {i: k for i, k in times.items() if k}
    check([(r.doc_id, r.text) for r in seen[4].collect()], seen[5].collect())
    whole = cp.run(spark, SF001)
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == \
        sorted(map(str, seen[5].drop("sequence_id", "offset").collect()))


def test_empty_table_and_extra_columns(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, _times int"
    rows = [(None, None, None, None, None, None, None, None), (1, "you idiot", "en", "a", 9, 0.1, 2, 3), (2, "one two three", None, None, 1, 0.0, 0, 0),
            (2, "one two three", None, None, 1, 0.0, 0, 0), (3, "token=abcdefgh12 rest of it", "en", "a", 7, 0.0, 0, 0), (4, "", "de", "b", 0, 0.0, 0, 0)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name == "packing":
                assert (out.count() > 0) == bool(data)
            else:
                assert out.columns == docs.columns and out.count() <= 2 * len(data)
                docs = out.checkpoint() if data else out


def test_every_operator_is_registered():
    names = list(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "secrets", "source_mix", "packing"]
