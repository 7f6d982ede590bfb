"""BPE against the tiktoken library, and the exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from connlens.llm import bpe, pretokens
from connlens.llm.plans import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, token_ids string"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def encoding(vocabulary):
    ranks = dict(zip(vocabulary.tokens, vocabulary.ids.tolist(), strict=True))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_classes_agree(vocabulary):
    assert (vocabulary.classes == pretokens.tokenizers_classes()).all()


def test_random_texts(vocabulary, encoding):
    rng = random.Random(5)
    codec = bpe.Codec(vocabulary)
    alphabet = "ab s tred'l1٣é '\n\t   　!?.漢Ⅷ\x1c\x85​😀\x00<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["a" * 3000, "ab" * 700, "".join(rng.choice("abcdefgh=/+XYZ") for _ in range(500)), " " * 500, "'s'll'", ""]
    ids, counts = codec.encode(texts)
    data, sizes = codec.decode(ids, counts)
    ends, places = np.cumsum(counts), np.cumsum(sizes)
    for i, text in enumerate(texts):
        assert ids[ends[i] - counts[i] : ends[i]].tolist() == encoding.encode_ordinary(text)
        assert bytes(data[places[i] - sizes[i] : places[i]]) == text.encode()


def test_rows(spark, encoding):
    rows = [(1, "Hello, world's end", "x"), (1, "Hello, world's end", "x"), (None, None, None), (3, "", "y"), (4, "word " * 60_000, "z")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr)
    assert found == sorted(((d, *digests(encoding, t)) for d, t, _ in rows), key=repr)
    tokens = bpe.encode(docs.drop("token_ids"), PATH)
    decoded = bpe.decode(tokens, PATH)
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in decoded.collect()) == sorted((d or 0, (t or "").encode()) for d, t, _ in rows)
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []


def test_query(spark, data, encoding):
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op1_bpe_round_trip"](spark, data).collect()}
    assert found == {r.doc_id: digests(encoding, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()}


def test_an_idle_worker_forgets_older_words():
    """Between tasks a codec holds one generation of words at most."""
    codec = bpe.Codec(bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    codec.ids_of.size = codec.bytes_of.size = 3
    first = codec.encode(["one two three four five", "six seven eight"])
    codec.decode(*first)
    assert codec.ids_of.old
    codec.rest()
    assert not codec.ids_of.old and not codec.bytes_of.old
    again = codec.encode(["one two three four five", "six seven eight"])
    assert again[0].tolist() == first[0].tolist()
