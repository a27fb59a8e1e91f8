import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pulsevault.llm import packing
from pulsevault.llm.tokens import FlatEncoder, tokenizer_path

from .helpers import ODD, documents, text

TOKENIZER = Tokenizer.from_file(tokenizer_path())


def ids_of(t):
    return [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2]


def best_fit_decreasing(lengths, capacity):
    rooms, n = [], 0
    for s in sorted(lengths, reverse=True):
        i = bisect_left(rooms, s)
        r = rooms.pop(i) if i < len(rooms) else capacity
        n += r == capacity
        insort(rooms, r - s)
    return n


@pytest.mark.parametrize("t", ["", " a", "a ", "a  b", "a   b", "\n\nx", " \n", "x\n", "\tfoo bar", "foo\xa0bar", "don't we'll", "a1b2 ³ ½", "日本語 です", "a\x1cb", "<|endoftext|> x", "ab.\ncd", "a\r\nb", "😀 a😀", "a\x00 \x00b", "."])
def test_encoder_equals_library(t):
    assert FlatEncoder(tokenizer_path()).encode(t) == np.array(ids_of(t)[:-1], "<u4").tobytes()


def test_encoder_with_full_memory():
    few = FlatEncoder(tokenizer_path(), limit=3)
    for i in range(20):
        t = text(i, 30) + ". End, of " + text(i + 1, 5)
        assert few.encode(t) == np.array(ids_of(t)[:-1], "<u4").tobytes()


@pytest.mark.parametrize("seed", range(12))
def test_plan_holds_every_length_and_is_tight(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 7, 300, 5000])
    lengths = [min(1024, max(1, int(rng.lognormvariate(5.5, 1)))) if seed % 2 else rng.randint(1, 1024) for _ in range(n)]
    patterns, held = packing.plan(Counter(lengths)), Counter()
    for times, content in patterns:
        assert times > 0 and sum(a * c for a, c in content) <= 1024
        for a, c in content:
            held[a] += times * c
    assert held == Counter(lengths)
    used = sum(t for t, _ in patterns)
    assert used <= best_fit_decreasing(lengths, 1024) + 2
    assert used <= min(sum(t for t, _ in packing._plan(Counter(lengths), 1024, g)) for g in packing.GROUPS)


def check(spark, rows, df):
    got = df.collect()
    want = Counter()
    for doc_id, t in rows:
        ids = ids_of(t)
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places), sum(r.length for r in got)


def test_pack_odd_rows(spark):
    check(spark, ODD, packing.pack(documents(spark, ODD, extra=True)))


def test_pack_empty(spark):
    assert packing.pack(documents(spark, [])).count() == 0


def test_pack_many_with_hot_length(spark):
    rows = [(i, "same few words" if i % 3 == 0 else text(i, 5 + i % 700)) for i in range(600)]
    n, total = check(spark, rows, packing.pack(documents(spark, rows)))
    assert n <= -(-total // 1024) * 1.05 + 1


def test_sequences_hold_the_tokens(spark):
    rows = [(i, text(i, 40 + 13 * i)) for i in range(40)]
    got = packing.sequences(documents(spark, rows)).collect()
    ids = sorted(x for r in got for x in np.frombuffer(r.ids, "<u4").tolist())
    assert ids == sorted(x for _, t in rows for x in ids_of(t)) and max(len(r.ids) for r in got) <= 4096
