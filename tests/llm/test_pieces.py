import sentencepiece

from conftest_llm import rows_of
from tillwise.llm import pieces
from tillwise.llm.vocabulary import vocabulary_path
from test_token_counts import TEXTS


def plain_best(model, part, score, ids):
    """All pieces ending at each place, longest first."""
    best = [(0.0, [])]
    for end in range(1, len(part) + 1):
        top = None
        for start in range(max(0, end - 16), end):
            piece = part[start:end]
            if piece in score:
                new = best[start][0] + score[piece], [*best[start][1], ids[piece]]
            elif end - start == 1:
                new = (best[start][0] + model.unknown,
                       [*best[start][1], *(model.byte_ids[b] for b in piece.encode())])
            else:
                continue
            if top is None or new[0] > top[0]:
                top = new
        best.append(top)
    return best[-1][1]


def test_segmentation_is_the_best_one_and_comes_back(docs_of):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())
    model = pieces.pieces_of(vocabulary_path())
    plain = [i for i in range(library.vocab_size()) if not (
        library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
    score = {library.id_to_piece(i): library.get_score(i) for i in plain}
    ids = {library.id_to_piece(i): i for i in plain}
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "a b")]
    got = pieces.encode(docs_of(rows), vocabulary_path())
    want = []
    for i, t in rows:
        text = (t or "")[:400] if len(t or "") > 10_000 else t or ""
        best = plain_best(model, pieces.SPACE + text.replace(" ", pieces.SPACE), score, ids) if text else []
        if len(t or "") <= 10_000:
            want.append((i, len(best), best, True))
        else:
            assert list(model.encode(text)) == best
    kept = [r for r in rows_of(got, "doc_id", "n_pieces", "ids", "round_trip") if r[1] < 50_000]
    assert kept == sorted(want, key=repr)
    assert all(r["round_trip"] for r in got.collect())
    back = rows_of(pieces.decode(got, vocabulary_path()), "doc_id", "text")
    assert back == sorted(((i, (t or "").replace(pieces.SPACE, " ")) for i, t in rows), key=repr)


def test_an_empty_table(docs_of):
    assert pieces.encode(docs_of([]), vocabulary_path()).count() == 0
