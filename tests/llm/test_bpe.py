"""op9: ids as the public library gives them, and the way back."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from registrum.llm import bpe_duckdb as bpe


@pytest.fixture(scope="module")
def public():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids(public):
    rng = random.Random(6)
    letters = "ab the' \n\t\x85\xa0\x1c\x1f　é漢字1²Ⅳ!?\0\U0001f600sS t́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3_000)]
    texts += ["", " ", "  a", "a  ", "don't we'll", "a" * 2_000, "thethe" * 200, "".join(rng.choice("abcdeth") for _ in range(1_500)), "x" * 257, "é" * 300]
    own = bpe.Codec()
    ids = own.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [public.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]
    # any ids decode, also such as no text encodes to
    some = [np.array([rng.randrange(50_256) for _ in range(rng.randint(0, 20))], "<u4") for _ in range(50)]
    assert own.decode([x.tobytes() for x in some]) == [public.decode_bytes(x.tolist()) for x in some]


def test_every_token_is_its_own_encoding():
    """What makes it right to contract all occurrences of the least pair at once."""
    own = bpe.Codec()
    tokens = [t for t in own.ranks if len(t) > 1][::7]
    assert own._contract(tokens) == [own.ranks[t].to_bytes(4, "little") for t in tokens]


def test_rows(public, spark, odd_documents, no_documents):
    df, rows = odd_documents
    encoded = bpe.encode(df.drop("key"))
    back = bpe.decode(encoded).select("row.*", "ids", "decoded").collect()
    assert len(back) == len(rows)
    for r in back:
        assert bytes(r.decoded) == (r.text or "").encode()
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == public.encode_ordinary(r.text or "")
    digest = lambda x: hashlib.sha256(x).hexdigest()
    wanted = sorted((r.doc_id, len(r.ids) // 4, digest(bytes(r.ids)), digest(bytes(r.decoded))) for r in back if r.doc_id is not None)
    assert sorted(tuple(r) for r in bpe.digests(df).where("doc_id IS NOT NULL").collect()) == wanted
    assert bpe.digests(no_documents).collect() == [] and bpe.encode(no_documents).collect() == []
