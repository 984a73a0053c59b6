import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa

from propensity.llm import repair_tokens as R
from propensity.llm.chunk_encoder import encoder

BYTE = P.path("byte_bpe_50k.json")


def packed(texts):
    enc = encoder(BYTE)
    grammar, symbols, ends = R.compress(*enc.entries(pa.array(texts)), enc.size, 0)
    row = {"vocabulary": enc.size, "doc_ids": np.arange(len(texts)).astype("<i8").tobytes(),
           "doc_ends": ends.astype("<i8").tobytes(), "rules": grammar.rules.astype("<u4").tobytes(),
           "lengths": grammar.lengths.astype("<u4").tobytes(), "symbols": symbols.astype("<u4").tobytes()}
    return R.Shard(row), symbols, ends


def plain(texts):
    enc = encoder(BYTE)
    entry, per_doc, ids, start, count = enc.entries(pa.array(texts))
    out, at = [], 0
    for n in per_doc:
        for e in entry[at:at + n]:
            out += ids[start[e]:start[e] + count[e]].tolist()
        out.append(0)
        at += n
    return out


def no_frequent_pair(symbols, ends):
    count, held = Counter(), None
    inner = set(range(len(symbols))) - set((ends - 1).tolist())
    for k in sorted(inner):
        pair = (symbols[k], symbols[k + 1])
        overlaps = held == (k - 1, pair) and pair[0] == pair[1]
        if not overlaps:
            count[pair] += 1
        held = None if overlaps else (k, pair)
    return max(count.values(), default=0) < R.MIN_COUNT


def test_copies_of_a_text_become_one_symbol_each():
    words = random.Random(1).sample([f"{a}{b}" for a in ("red", "old", "tin", "far") for b in range(100)], 300)
    texts = [" ".join(words)] * 64
    shard, symbols, ends = packed(texts)
    assert len(symbols) == len(texts)
    assert shard.tokens()[0].tolist() == plain(texts)


def test_rounds_end_only_when_no_pair_is_frequent():
    r = random.Random(2)
    phrases = [" ".join(r.choices(["one", "two", "be", "or", "not", "to", "the", "sea"], k=6)) for _ in range(40)]
    texts = [". ".join(r.choices(phrases, k=r.randrange(30))) for _ in range(200)] + ["a b " * 3000, "", "x" * 999, "na" * 999]
    shard, symbols, ends = packed(texts)
    assert shard.tokens()[0].tolist() == plain(texts)
    assert no_frequent_pair(symbols, ends)
    assert (np.diff(ends, prepend=0) > 0).all() and ends[-1] == len(symbols)
