import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landgrid.llm import packing
from landgrid.llm.packing import CapacityTree, best_fit_plan, default_tokenizer, pack_documents


def brute_best_fit(lengths, window):
    """Best-fit decreasing, piece by piece: remaining capacities."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            best = min(fits)
            free[free.index(best)] = best - n
        else:
            free.append(window - n)
    return sorted(free)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    window = 64
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = best_fit_plan(histogram, window)
    fill, spans = defaultdict(int), defaultdict(list)
    for i, (length, rank, k, first, offset) in enumerate(plan):
        end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == length else histogram[length]
        for r in range(rank, end):
            s, o = first + (r - rank) // k, offset + (r - rank) % k * length
            spans[s].append((o, length))
            fill[s] += length
    for s, held in spans.items():
        at = 0
        for o, n in sorted(held):
            assert o == at
            at += n
        assert at <= window
    assert sorted(window - f for f in fill.values()) == brute_best_fit(lengths, window)
    assert sorted(fill) == list(range(len(fill)))


def test_tree():
    t = CapacityTree(10)
    assert t.tightest(1) == -1
    t.add(7, 2)
    t.add(10, 1)
    assert (t.tightest(3), t.tightest(7), t.tightest(8), t.tightest(10)) == (7, 7, 10, 10)
    t.add(7, -2)
    assert t.tightest(3) == 10


def check(rows, docs, window):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    want = defaultdict(int)
    for doc_id, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), window):
            part = np.array(ids[at : at + window], "<u4")
            want[doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    got = defaultdict(int)
    by = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        by[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for held in by.values():
        at = 0
        for o, n in sorted(held):
            assert o == at
            at += n
        assert at <= window
    assert sorted(window - sum(n for _, n in v) for v in by.values()) == brute_best_fit([k[2] for k, n in want.items() for _ in range(n)], window)


TEXTS = [
    "", None, " \n\t", "It's a TEST, don't stop! 1234 ÉÀ é İ K ǅ", "x<|endoftext|>y <|startoftext|>", "word " * 3000, "ab\x0bcd\x0cef\x1cgh\x85ij",
    "日本語テキスト 🙂🙂 ﷽", "tie one", "tie one", "'s 't ''ll I'LL we'Re", "a" * 3000,
]


@pytest.mark.parametrize("window", [64, 4096])
def test_pieces_and_places(spark, window):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(8, "tie one"), (None, "lost id"), (None, None)]
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, length int")
    check(pack_documents(df, default_tokenizer(), window=window).collect(), docs, window)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(df, default_tokenizer()).collect() == []


def test_query(spark):
    from landgrid.llm.packing import op7_packing

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    a = op7_packing(spark, sf).collect()
    check(a, docs, 4096)
    assert sorted(a) == sorted(op7_packing(spark, sf).collect())


def test_a_kept_encoder_gives_the_same_ids_whatever_it_has_forgotten(monkeypatch):
    """Words in several cases, accents, decomposed letters, look-alike letters, marks and ids of a full memo."""
    from tokenizers import Tokenizer

    texts = [
        "Straße STRASSE Ünï, naïve... café Éa! Kelvin Ångström İstanbul ΣΑΣ don't it's a'b",
        "word word, Word; WORD) x<|endoftext|> <|startoftext|> 12ab ab12 ß÷× ÿ Ÿ  a\u0085b\x1cc",
        " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q," for i in range(900)),
    ]
    whole = Tokenizer.from_file(packing.default_tokenizer())
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    monkeypatch.setattr(packing, "MEMO", 50)
    kept = packing.Encoder(packing.default_tokenizer())
    for _ in range(3):
        for t, ids in zip(texts, expected):
            assert kept([t.encode()]) == [ids]
    assert len(kept.elder) > 0
