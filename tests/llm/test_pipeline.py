import corpus_pipeline
from conftest_llm import SF
from tillwise.llm import contamination, pieces, quality, secrets, simhash
from tillwise.llm.tables import keep, table
from tillwise.llm.vocabulary import vocabulary_path


def test_stages_by_plain_python(spark):
    """Each stage against what single texts say on their own."""
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination",
                     "secret_scans", "sentencepiece"]
    stages = [f for _, f in corpus_pipeline.STAGES]
    columns = docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in quality.scored(
        docs, table(spark, SF, "labels")).collect()}

    good = keep(stages[0](spark, docs, SF), "t")
    assert good.columns == columns
    ids = {r["doc_id"] for r in good.collect()}
    assert ids == {i for i, p in scores.items() if p == 1}

    one = keep(stages[1](spark, good, SF), "t")
    assert one.columns == columns
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in good.collect()}
    group = {i: i for i in prints}
    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    ordered = sorted(prints)
    for k, i in enumerate(ordered):
        for j in ordered[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    assert {r["doc_id"] for r in one.collect()} == {root(i) for i in prints}

    clean = keep(stages[2](spark, one, SF), "t")
    assert clean.columns == columns
    items = [" ".join(contamination.words_of(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    texts = {r["doc_id"]: " ".join(contamination.words_of(r["text"])) for r in one.collect()}
    left = {r["doc_id"] for r in clean.collect()}
    for i, text in texts.items():
        assert (i in left) == (not any(f" {item} " in f" {text} " for item in items))

    safe = keep(stages[3](spark, clean, SF), "t")
    assert safe.columns == columns and safe.count() == clean.count()
    from tillwise.session import working_folder
    ledger = secrets.update_ledger(safe, working_folder(spark, "ledger"))
    assert secrets.report(safe, ledger).where("spans <> ''").count() == 0

    last = keep(stages[4](spark, safe, SF), "t")
    model = pieces.pieces_of(vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in safe.collect()}
    rows = last.collect()
    assert len(rows) == len(texts)
    assert all(model.decode(r["ids"]) == texts[r["doc_id"]].replace(pieces.SPACE, " ") for r in rows)


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "n_pieces", "ids", "round_trip"]
    assert found.where("not round_trip").count() == 0
    assert 0 < found.count() < table(spark, SF, "documents").count()


def test_odd_rows_pass_through_the_stages(docs_of, spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b c d e f"), (4, "word and more. " * 50_000), (5, "é")]
    docs = docs_of(rows)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = keep(stage(spark, docs, SF), name)
        assert docs.columns == docs_of([]).columns
    assert {r["doc_id"] for r in docs.collect()} == {1, None, 4, 5}
    none = docs_of([])
    for name, stage in corpus_pipeline.STAGES:
        none = keep(stage(spark, none, SF), name)
    assert none.count() == 0
