import inspect

import corpus_pipeline
import __spark_entry__
from tests.llm.fixtures import prose
from tests.llm.test_dedup import PASSAGE

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_dir):
    item = prose(77, 30)
    texts = {i: prose(2000 + i, 80) for i in range(40)}
    texts |= {50: texts[3], 51: texts[3], 60: prose(61, 40) + " " + item + " " + prose(62, 40), 70: prose(63, 60) + " Head. " + PASSAGE + " Tail.", 71: prose(64, 60) + " Top. " + PASSAGE + " End."}
    texts |= {80 + i: prose(3000 + i, 50) + " you idiot moron, pathetic scum. " + prose(4000 + i, 20) for i in range(12)}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()] + [(90, None, None, None, None), (91, "", "en", "s", 0), (None, prose(5, 30), "en", "s", 5)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 80)) for i in [*range(30), *range(80, 90)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        assert len(inspect.signature(stage).parameters) == 3
        out = stage(spark, docs, tmp_dir)
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        if name != "byte_bpe":
            assert docs.columns == names
        kept[name] = {r.doc_id: r for r in docs.collect()}
    clean = {*range(40), 70, 71, 90, 91, None}
    assert set(kept["toxicity"]) == clean | {50, 51, 60}
    assert set(kept["ngram_join"]) == clean | {60}
    assert kept["substring_dedup"][70].text == texts[70] and "passage" not in kept["substring_dedup"][71].text
    assert kept["substring_dedup"][71].n_chars == len(kept["substring_dedup"][71].text)
    assert all(kept["substring_dedup"][i].text == texts[i] for i in range(40))
    assert set(kept["decontamination"]) == clean == set(kept["byte_bpe"])


def test_entry_registers_everything():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
