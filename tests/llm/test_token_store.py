import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from edges import TEXTS, documents
from tokenizers import Tokenizer

from marlstone.llm import queries, token_store
from marlstone.storage import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest(r[1] or "", 42)).astype(np.int64))):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_round_trip(spark):
    path = new_path(spark, "store")
    token_store.write_store(documents(spark), path, PATH)
    got = sorted((tuple(r) for r in token_store.read_store(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(TEXTS)
    found = {r.doc_id: r.ids for r in token_store.lookup(spark, path, [4, 9, 777]).collect()}
    assert set(found) == {4, 9}
    assert found[4] == [*Tokenizer.from_file(PATH).encode(dict(TEXTS)[4]).ids, 2]


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in queries.op1_token_store(spark, sf).collect()) == expected(docs)


def test_empty_table(spark):
    path = new_path(spark, "store")
    token_store.write_store(documents(spark, []), path, PATH)
    assert token_store.read_store(spark, path).count() == 0


def test_wrong_dictionary(spark):
    one, two = new_path(spark, "store"), new_path(spark, "store")
    token_store.write_store(documents(spark), one, PATH)
    token_store.write_store(documents(spark, [(i, f"word{i} and more text {i * i}") for i in range(400)]), two, PATH)
    spark.read.parquet(f"{two}/dictionary").write.mode("overwrite").parquet(f"{one}/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        token_store.read_store(spark, one).collect()


def test_chunks_give_the_ids_of_whole_texts():
    rng, tok, encode = random.Random(1), Tokenizer.from_file(PATH), token_store.Encoder(PATH)
    parts = ["a", "the", " ", "  ", "\n", "\t", " ", " ", "　", "\x85", "\x1c", "​", "!", "'s", "é", "日", "\U0001f642", "12", "<|endoftext|>", "-", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    for _ in range(2):  # the second time from memory
        ids, at = encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
