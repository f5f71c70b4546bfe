import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from edges import TEXTS, documents

from marlstone.llm import piece_fst, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
MACHINE, LIBRARY = piece_fst.Transducer(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def encode(texts):
    flat, at = MACHINE.encode(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(at, at[1:])]


@pytest.mark.parametrize("seed", range(3))
def test_ids_equal_the_library(seed):
    rng = random.Random(seed)
    letters = "abcdetnsrio  \n.,THE\U0001f642é▁\t日0123"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", " ", " " * 40, "   hello   world  ", "\n\n x", "the" * 40, "a" * 500, "x\x00y", " " * 15 + "a"]
    assert encode(texts) == LIBRARY.encode(texts)
    assert MACHINE.decode(LIBRARY.encode(texts)) == [t.replace("▁", " ") for t in texts]


def test_query(spark, sf):
    import zlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {i: LIBRARY.encode(t) for i, t in docs.items()}
    got = {r.doc_id: (r.n_ids, r.ids_crc32, r.round_trip) for r in queries.op7_sentencepiece(spark, sf).collect()}
    assert got == {i: (len(v), zlib.crc32(np.array(v, "<u4").tobytes()), True) for i, v in want.items()}


def test_edges(spark):
    docs = documents(spark)
    rows = piece_fst.decode(piece_fst.encode(docs, PATH), PATH).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.text is None:
            assert r.ids is None and r.n_ids is None and r.decoded is None
        else:
            assert r.ids == LIBRARY.encode(r.text) and r.n_ids == len(r.ids) and r.decoded == r.text.replace("▁", " ")
    assert piece_fst.encode(documents(spark, []), PATH).count() == 0


def test_pairs_side_by_side():
    """B against merging itself."""
    rng = random.Random(4)
    ids = [i for i, p in enumerate(MACHINE.names) if p in MACHINE.lexicon and MACHINE.reached[i] and "▁▁" not in p]
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(3000)]
    got = MACHINE.beside(*(np.array(x) for x in zip(*pairs)))
    for (a, b), ok in zip(pairs, got):
        word = [MACHINE.lexicon[c] for c in MACHINE.names[a] + MACHINE.names[b]]
        assert ok == (piece_fst.merge(word, MACHINE.pair_list, MACHINE.scores) == [a, b])


def test_character_map(tmp_path):
    """A model with a stock normaliser gives the library's ids: the map, squeezed spaces, no prefix or one."""
    from sentencepiece import sentencepiece_model_pb2 as model

    rng = random.Random(8)
    letters = "abe ﬁ①Ａ　ｶﾞ\u0301\u0308é\u1100\u1161\u11a8ﷺ½\u200b\t▁ 日\u00ad²"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", "  ", "▁▁a▁", " a  b ", "ﬁ  ﬁ "]
    for rule, prefix, squeeze in (("nfkc", True, True), ("nmt_nfkc_cf", True, False), ("nmt_nfkc", False, True)):
        proto = piece_fst._proto(PATH)
        spec = model.ModelProto()
        spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.CopyFrom(spec.normalizer_spec)
        proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces, proto.normalizer_spec.escape_whitespaces = prefix, squeeze, True
        path = tmp_path / f"{rule}.model"
        path.write_bytes(proto.SerializeToString())
        machine, library = piece_fst.Transducer(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
        flat, at = machine.encode(pa.array(texts))
        want = library.encode(texts)
        assert [(t, flat[a:b].tolist()) for t, a, b in zip(texts, at, at[1:])] == list(zip(texts, want))


def test_words_that_hashes_lead_astray(monkeypatch):
    """Pieces found by a wrong hash are noticed, and the word is solved by texts."""
    other = piece_fst.Transducer(PATH)
    wrong = {piece_fst._text_hashes([a])[0]: other.lexicon[b] for a, b in (("\u2581the", "\u2581and"), ("ing", "ion"), ("a", "b"))}
    get = other.pieces.get
    monkeypatch.setattr(other.pieces, "get", lambda keys: np.array([wrong.get(k, v) for k, v in zip(keys, get(keys))], np.int32))
    texts = ["the thing and the other", "a", "running to the sea", "no harm"]
    flat, at = other.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == LIBRARY.encode(texts)


def test_unigram_shortest_path(tmp_path, monkeypatch):
    """With weights of its own the path is the cheapest of all."""
    from sentencepiece import sentencepiece_model_pb2 as model

    proto, rng = model.ModelProto(), random.Random(2)
    proto.pieces.add(piece="<unk>", score=0, type=2)
    vocabulary = {}
    for p in ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "cab", "ca"]:
        vocabulary[p] = -rng.uniform(1, 6)
        proto.pieces.add(piece=p, score=vocabulary[p], type=1)
    for b in range(256):
        proto.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    proto.trainer_spec.byte_fallback = True
    proto.trainer_spec.model_type, proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.escape_whitespaces, proto.normalizer_spec.remove_extra_whitespaces = 1, True, True, False
    path = tmp_path / "u.model"
    path.write_bytes(proto.SerializeToString())
    machine = piece_fst.Transducer(str(path))
    for _ in range(200):
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 9)))
        line = "▁" + text.replace(" ", "▁")
        best = {0: (0.0, [])}
        for i in range(1, len(line) + 1):
            best[i] = min(((best[j][0] - vocabulary[line[j:i]], best[j][1] + [line[j:i]]) for j in range(i) if line[j:i] in vocabulary), key=lambda x: x[0])
        flat, _ = machine.encode(pa.array([text]))
        assert -sum(vocabulary[machine.names[i]] for i in flat) == pytest.approx(best[len(line)][0])
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["".join(rng.choice("abc é日") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    flat, at = machine.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == library.encode(texts)
    assert machine.solve_plainly("▁abcéab") == library.encode("abcéab")
    del proto.pieces[len(vocabulary) + 1 :]  # without byte pieces
    proto.trainer_spec.byte_fallback = False
    path.write_bytes(proto.SerializeToString())
    machine, library = piece_fst.Transducer(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    flat, at = machine.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == library.encode(texts)
