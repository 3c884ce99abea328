import sentencepiece

from conftest_llm import rows_of
from tillwise.llm import token_counts
from tillwise.llm.vocabulary import vocabulary_path

TEXTS = ["", " ", "  ", "\n", "\n\n a", "a  b \n  c", "▁▁x▁ y", " ▁ ▁", "\x00 a\x00",
         "日本語 テスト 梦梦", "😀😀 é", "a\r\nb", "<s> </s><unk><0x0A>", "\t\ta", "x" * 5000,
         " " * 40 + "a", "a" + " " * 33, None, "The the of " * 30_000, "​　 a"]


def test_counts_are_those_of_the_library(docs_of):
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (5, TEXTS[5]), (5, TEXTS[5]), (5, "other"), (None, "a b")]
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows]
    for frequent in (1, 10_000):
        got = rows_of(token_counts.token_counts(docs_of(rows), vocabulary_path(), frequent=frequent),
                      "doc_id", "n_bytes", "n_tokens", "over_limit")
        assert got == sorted(want, key=repr)


def test_a_long_token_in_every_row(docs_of):
    """A ruler line travels to the tasks; one too long for that is spread over several places."""
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())
    ruler, longer = "=-" * 30, "ab1" * 400
    rows = [(i, f"row{i} {ruler} {longer} end") for i in range(500)]
    docs = docs_of(rows)
    assert f" {ruler}" in token_counts.frequent_pieces(docs, vocabulary_path())
    got = rows_of(token_counts.token_counts(docs, vocabulary_path()), "doc_id", "n_tokens")
    assert got == sorted(((i, len(model.encode(t))) for i, t in rows), key=repr)
    before = token_counts.TABLE_BYTES
    try:
        token_counts.TABLE_BYTES = 70  # what does not fit goes the general way
        assert len(token_counts.frequent_pieces(docs, vocabulary_path())) < 4
        assert rows_of(token_counts.token_counts(docs, vocabulary_path()), "doc_id", "n_tokens") == got
    finally:
        token_counts.TABLE_BYTES = before


def test_an_empty_table(docs_of):
    assert token_counts.token_counts(docs_of([]), vocabulary_path()).count() == 0
