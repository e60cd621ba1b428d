import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pathlib import Path  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from noticelake.llm.packing import Packer, fill_report, hilbert_key, pack  # noqa: E402
from noticelake.llm.splitting import TokenMap, pieces, split_corpus  # noqa: E402
from noticelake.llm.tokens import Encoder, default_vocabulary, encode_corpus, sentencepiece_model  # noqa: E402

ENCODER = Encoder(sentencepiece_model(Path(default_vocabulary()).read_bytes()))
PEER = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
PEER.encode_special_tokens = True
ODD = ["", " ", "\r\n\t  x", "Zażółć gęślą jaźń, it's <|endoftext|> 中国 👩‍👩‍👧 ﻿\x00\x1f", "a" * 30000, "1234567890" * 500, "І" * 5000, "don't  stop\n\n\nnow ", "  　x"]
DOC = "doc_id bigint, text string, ids string, lang string"


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_same_ids_as_the_public_library_and_back(text):
    ids = ENCODER.encode(text)
    assert ids == PEER.encode(text, add_special_tokens=False).ids and ENCODER.decode(ids) == text


def test_odd_texts_and_corpus(spark):
    for t in ODD:
        assert ENCODER.encode(t) == PEER.encode(t, add_special_tokens=False).ids and ENCODER.decode(ENCODER.encode(t)) == t and ENCODER.size(t) == len(ENCODER.encode(t))
    docs = [*enumerate(ODD), (90, None), (None, "x"), (0, "x"), (0, "x")]
    got = encode_corpus(spark.createDataFrame([(i, t, "clash", None) for i, t in docs], DOC)).collect()
    assert sorted((repr(r.doc_id), list(r.ids)) for r in got) == sorted((repr(i), ENCODER.encode(t)) for i, t in docs)
    assert encode_corpus(spark.createDataFrame([], DOC)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["słowo ", "Zdanie. ", "\n\n", "linia\n", "x" * 40, "中国語", "👩‍👧", "1,2; ", "  "]), min_size=10, max_size=150), st.integers(24, 80), st.integers(0, 3))
def test_pieces_cover_stay_under_the_limit_and_overlap(parts, limit, overlap):
    text, overlap = "".join(parts), min(overlap, limit // 2 - 1)
    m = TokenMap(ENCODER, text, *next(ENCODER.marked([text])))
    assert m.size == ENCODER.size(text)
    out = pieces(m, limit, overlap)
    assert out[0][2] == 0 and out[-1][3] == len(text)
    for (s, e, a, z, n, _), nxt in zip(out, [*out[1:], None], strict=True):
        assert n == ENCODER.size(text[a:z]) <= limit and s < e
        if nxt:
            assert s < nxt[0] and overlap <= e - nxt[0] <= overlap + 8 and nxt[2] <= z


def test_natural_ends_and_whole_rows(spark):
    text = "\n\n".join(f"Akapit {i}. " + "Zdanie ma kilka słów i kończy się kropką. " * 6 for i in range(30))
    docs = spark.createDataFrame([(1, text, None, None), (2, "krótki", None, None), (3, "", None, None), (4, None, None, None), (5, "x" * 40000, None, None)], DOC)
    got = split_corpus(docs, 128, 16).collect()
    by = {d: sorted((r for r in got if r.doc_id == d), key=lambda r: r.piece_no) for d in range(1, 6)}
    assert all(r.n_tokens <= 128 and r.n_pieces == len(by[r.doc_id]) for r in got)
    assert {r.boundary for r in by[1]} <= {"paragraph", "sentence", "end"} and by[1][0].text == text[: by[1][0].end_char]
    assert [(r.boundary, r.text) for d in (2, 3, 4) for r in by[d]] == [("whole", "krótki"), ("whole", ""), ("whole", None)]
    assert {r.boundary for r in by[5]} == {"hard", "end"}


def test_hilbert_curve_steps_to_a_neighbour():
    import numpy as np

    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = cells[np.argsort(hilbert_key(cells, 3))]
    assert sorted(hilbert_key(cells, 3)) == list(range(512)) and (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_packing_places_every_token_once(spark):
    docs = [(i, "słowo " * (i % 90), None, None) for i in range(700)] + [(800, "długi tekst " * 3000, None, None), (801, None, None, None), (802, "", None, None), (803, "x", None, None), (803, "x", None, None)]
    got = pack(spark.createDataFrame(docs, DOC), capacity=256, window=100).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r.container_id, []).append((r.place, r.n_tokens))
    for items in sizes.values():
        items.sort()
        assert all(a[0] + a[1] <= b[0] for a, b in zip(items, items[1:], strict=False)) and items[-1][0] + items[-1][1] <= 256
    want = sorted((i, ENCODER.size(t)) for i, t, *_ in docs)
    have = {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.n_tokens
    assert have == {i: sum(n for j, n in want if j == i) for i, _ in want}
    assert all(r.part_no == 1 for r in got if have[r.doc_id] <= 256)
    rep = fill_report(spark.createDataFrame(got), 256).first()
    assert rep.n_items == len(got) and rep.fill > 0.9
    assert pack(spark.createDataFrame([], DOC)).count() == 0


def test_packer_fills_exactly():
    p = Packer(10, 0)
    placed = list(p.window([(6,), (4,), (5,), (5,), (10,), (0,)]))
    assert sorted(n for _, _, (n,) in placed) == [0, 4, 5, 5, 6, 10] and {box for box, _, (n,) in placed if n} == {0, 1, 2}
