import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from .test_exact_line import brute_lines
from .test_simhash import brute_classes, brute_fingerprint

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    names = list(t[0])
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language_id"](spark, docs, SMALL)
    assert known.columns == names
    assert sorted(r["doc_id"] for r in known.collect()) == sorted(
        r["doc_id"] for r in t if r["text"] and any(map(str.isalpha, r["text"])))

    lines = stages["line_dedup"](spark, known, SMALL)
    assert lines.columns == names
    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    cut = {i: text for i, text, _, _ in brute_lines(rows)}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == cut

    near = stages["simhash_near_dedup"](spark, lines, SMALL)
    ids = sorted(cut)
    classes = brute_classes([brute_fingerprint(cut[i]) for i in ids])
    assert near.columns == names
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({ids[c] for c in classes})

    mixed = stages["mixing"](spark, near, SMALL)
    assert mixed.columns == names
    left = [r["doc_id"] for r in mixed.collect()]
    assert len(left) == len(set(left)) and set(left) <= {ids[c] for c in classes}
    labels = {r["doc_id"]: r for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist()}
    good = [i for i in {ids[c] for c in classes} if i in labels and labels[i]["quality"] == 1 and not labels[i]["toxic"]]
    toxic = [i for i in {ids[c] for c in classes} if i in labels and labels[i]["toxic"]]
    # 87 labels teach little; on larger tables nearly all good documents stay (test_mixing_query)
    assert np.mean([i in left for i in good]) > 0.6 > 0.4 > np.mean([i in left for i in toxic])

    packed = stages["best_fit_packing"](spark, mixed, SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(left)
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
        assert sum(n for _, n in parts) <= 4096


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SMALL)) == key(docs)


def test_stages_on_edges(spark, edge_rows):
    rows = [(i, t, "en", "s", 1) for i, t in edge_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= len(rows)


@pytest.mark.parametrize("good, poor, toxic", [(970, 20, 10), (990, 10, 0), (750, 120, 130), (900, 10, 90)])
def test_mixing_keeps_clean_text(spark, tmp_path, caplog, good, poor, toxic):
    """Good documents stay whatever the supply; only domains over their weight beside them are lowered."""
    caplog.set_level("INFO", logger="corpus_pipeline")
    words = {"good": "calm rivers carry boats", "poor": "click here buy now", "toxic": "nasty awful hateful insult"}
    domains = ["good"] * good + ["poor"] * poor + ["toxic"] * toxic
    docs = spark.createDataFrame([(i, f"{words[d]} {words[d]} number {i % 7}") for i, d in enumerate(domains)],
                                 "doc_id long, text string")
    spark.createDataFrame([(i, int(d == "good"), int(d == "toxic")) for i, d in enumerate(domains)],
                          "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left = [domains[r["doc_id"]] for r in corpus_pipeline.mix_to_weights(spark, docs, str(tmp_path)).collect()]
    assert left.count("good") >= 0.99 * good
    for domain, have, weight in (("poor", poor, 0.08), ("toxic", toxic, 0.02)):
        wanted = min(have, good / 0.9 * weight)
        assert abs(left.count(domain) - wanted) <= 4 * max(1, wanted) ** 0.5 + 0.01 * good * (have > wanted)
        assert have > wanted or left.count(domain) == have
    assert [r.getMessage().split()[1] for r in caplog.records] == ["good", "poor", "toxic"]


def test_rows_without_id_and_with_repeated_ids_are_told_apart(spark):
    """Null ids and repeated ids with different texts: dedup keeps one row of each class, drawing is by row."""
    from sunlight.llm import line_dedup, mixing, simhash
    rng = np.random.default_rng(11)
    text = lambda: " ".join("".join(chr(97 + int(c)) for c in rng.integers(0, 26, 7)) for _ in range(30))
    alone = [text() for _ in range(12)]
    rows = [(None, t) for t in alone] + [(None, alone[0])]           # 12 classes without id, one of them twice
    same, other, third = text(), text(), text()
    rows += [(5, same), (5, other), (5, other), (7, other), (7, third), (3, same)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = simhash.simhash_dedup(spark, docs)
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(None, t) for t in alone] + [(3, same), (5, other), (7, third)], key=str)

    lines = [(None, f"a line of rows without id\nown line {i} of this row") for i in range(6)] + \
        [(1, "a line of all kinds of rows"), (None, "a line of all kinds of rows\nlast own line")]
    cut = line_dedup.line_dedup(spark, spark.createDataFrame(lines, "doc_id long, text string").repartition(3)).collect()
    texts = [r["text"] for r in cut]
    assert sum("a line of rows without id" in t for t in texts) == 1
    assert sum("own line" in t for t in texts) == 7 and sum(r["n_dropped"] for r in cut) == 6
    assert [r["text"] for r in cut if r["doc_id"] == 1] == ["a line of all kinds of rows"]

    mixed = spark.createDataFrame([(None, 1, 1, 0.5)] * 400, "doc_id long, __tokens int, __cell int, __rate double")
    assert 140 < mixing.sample_by_rate(mixed).count() < 260
