from __future__ import annotations

import base64
import os
import random

import numpy as np
import pytest

encode = pytest.importorskip("tidemark.llm.encode")
pretokens = pytest.importorskip("tidemark.llm.pretokens")
tiktoken = pytest.importorskip("tiktoken")
if not os.path.exists(f"{encode.TOKENIZER_DIR}/{encode.BYTE_BPE}"):
    pytest.skip("no vocabulary files", allow_module_level=True)

# fixed value: the published splitting pattern of the vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def other():
    with open(f"{encode.TOKENIZER_DIR}/{encode.BYTE_BPE}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("other", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def mine():
    return encode.Encoder()


ODD = [
    "", " ", "   ", "\n\n", " \n x", "'s", "it's we've they're I'll he'd 'tis", "'", "''s", " 's", "\t's", "'sab", "'re", "'r", "'rx", "'ll'll", "'lx", "can't've",
    "<|endoftext|>", "a b", "日本語のテキスト。", "naïve café — “quotes” … 👍🏽🚀", "x" * 5000, "=" * 3000, " " * 2000, "1234567890" * 50, "\0\0a\0", "é", "　a",
    "a  b", "a   \n  b  ", "tab\tsep", "\r\n\r\n", "½ ² ① Ⅷ", "ſ'S 'S",
]


def ids(encoder, texts):
    return [x for x, _, _ in encoder.encode(texts)]


def test_odd_texts_match_another_implementation(mine, other):
    assert ids(mine, ODD) == [other.encode_ordinary(t) for t in ODD]


def test_random_texts_match_and_decode(mine, other):
    rng = random.Random(2)
    alphabet = "  \n\t'strevmldSTab12.,!'é日本 　👍́'''  \r\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(20_000)]
    got = ids(mine, texts)
    assert got == [other.encode_ordinary(t) for t in texts]
    assert all(mine.decode(x) == t.encode() for x, t in zip(got, texts))


def test_chunks_do_not_matter(mine, monkeypatch):
    texts = [*ODD, None, "last"]
    whole = ids(mine, texts)
    monkeypatch.setattr(encode, "CHUNK_CHARS", 10)
    assert ids(mine, texts) == whole and len(whole) == len(texts)


def test_offsets_lead_back_to_the_text(mine):
    text = "The value's offset: 12 日本 — done."
    _, where, parts = next(iter(mine.encode([text])))
    pieces = [text[a:b] for a, b in zip(where, [*where[1:], len(text)])]
    assert [mine.decode(p).decode() for p in parts] == pieces and "".join(pieces) == text


@pytest.mark.parametrize("block", [1, 2, 7, 256, 5000])
def test_blocked_scan_equals_one_step_at_a_time(block):
    rng = np.random.default_rng(block)
    kinds = rng.integers(0, 15, 3000).astype(np.uint8)
    state, want = 0, []
    for k in kinds:
        state = pretokens.transitions()[k, state]
        want.append(state)
    assert (pretokens.scan_states(kinds, block) == want).all()


def test_frame(spark, mine):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (3, "", "z"), (4, "a b", "w")], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in encode.token_ids(df).collect()}
    assert got == {1: ids(mine, ["a b"])[0], 2: [], 3: [], 4: ids(mine, ["a b"])[0]}
    assert {r.doc_id: r.n_tokens for r in encode.token_counts(df).collect()} == {1: 2, 2: 0, 3: 0, 4: 2}
    assert {r.doc_id: (r.slice_starts, r.slice_tokens) for r in encode.token_spans(df).collect()}[1] == ([0, 1], [1, 1])
    assert encode.token_ids(df.limit(0)).count() == 0


def test_documents_match(spark, data, other):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = encode.token_ids(documents).collect()
    assert len(got) == len(texts) and all(r.ids == other.encode_ordinary(texts[r.doc_id] or "") for r in got)
