import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.llm.data import documents, empty
from tidewell.llm import bpe
from tidewell.llm.arrays import flat_text

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TABLES = bpe.build_tables(RANKS)
REAL = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encode(texts):
    data, offsets = flat_text(pa.array(texts, pa.string()))
    ids, counts = bpe.encode_texts(data, offsets, TABLES)
    decoded, _ = bpe.decode_ids(ids, TABLES)
    assert decoded.tobytes() == data.tobytes()
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_boundaries_as_the_library_finds_them():
    pick = random.Random(3)
    parts = list("ab'strevlmd  \n\t\r1２é 　!,.$'́😀ßĲ") + ["'re", "'ll", "'s", "  ", "\x1c", "\x85", "ﬀ", "²", "Ⅷ", "<|endoftext|>"]
    texts = ["", None, " ", "\n", "'s", "''s", "a  b", "a \n b "] + ["".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(2000)]
    assert encode(texts) == [REAL.encode_ordinary(t or "") for t in texts]


def test_long_pieces_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    texts = ["x" * 1000, "=-" * 700, "ab cd ef gh ij", "supercalifragilistic" * 20, "the the the", "é" * 300]
    assert encode(texts) == [REAL.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("clashing", [False, True])
def test_round_trip_on_spark(spark, clashing):
    docs = documents(spark, clashing)
    shared = spark.sparkContext.broadcast(TABLES)
    apart = bpe.decode(bpe.encode(docs, shared), shared)
    at_once = bpe.round_trip(docs, shared)
    for result in (apart, at_once):
        for row in result.collect():
            assert row.ids == REAL.encode_ordinary(row.text or "")
            assert bytes(row.decoded) == (row.text or "").encode()
            assert [len(RANKS_BY_ID[i]) for i in row.ids] == list(np.diff([0, *row.token_ends]))
    assert bpe.round_trip(empty(spark), shared).count() == 0


RANKS_BY_ID = {rank: token for token, rank in RANKS.items()}
