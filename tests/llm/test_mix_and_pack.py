"""Mixing and packing: exact targets, gapless sequences, ids against the tokenizer itself; the pipeline as a whole."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import DATA
from llm_data import DOCUMENTS, documents, no_documents
from tokenizers import Tokenizer

import corpus_pipeline
from flowtables.llm import mixing, packing
from flowtables.llm.common import table, vocabulary


@pytest.mark.parametrize("size", [1, 2, 3, 10, 64, 1_000])
def test_permutations_and_their_inverses(size):
    there = mixing.permuted(np.arange(size), size, 12_345)
    assert sorted(there) == list(range(size))
    assert (mixing.permuted(there, size, 12_345, inverse=True) == np.arange(size)).all()


def test_targets_stop_at_the_cap_and_are_shared_again():
    got = mixing.targets([100, 1_000, 1_000, 0, 50], [5, 2, 1, 5, 2], 1.5, 2)
    assert abs(sum(got) - 1.5 * 2_150) < 1e-6 and got[0] == 200 and got[3] == 0 and got[4] == 100
    assert got[1] == 2_000 or abs(got[1] - 2 * got[2]) < 1e-6


def check_mix(got, docs, mix=mixing.Mix()):
    by, seen = defaultdict(list), Counter()
    for r in got:
        assert 0 <= r.taken <= mix.passes * r.size
        seen[r.doc_id, r.size] += 1
    assert seen == Counter((d[0], len((d[1] or "").split())) for d in docs)
    for r in got:
        by[r.source_size, r.target].append(r)
    for (size, target), rs in by.items():
        assert sum(r.size for r in rs) % size == 0 if size else True
    assert abs(sum(r.taken for r in got) - mix.share * sum(r.size for r in got)) <= len({d[3] for d in docs})


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix(block=7, shard=5), mixing.Mix(weights=(1,), block=1, shard=50)])
def test_mix_of_awkward_rows(spark, mix):
    got = mixing.mixture(documents(spark), mix).collect()
    check_mix(got, DOCUMENTS, mix)
    again = mixing.mixture(documents(spark).repartition(5), mix).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_of_nothing(spark):
    assert mixing.mixture(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 0), (2, " ", None, 1)], "doc_id long, text string, source string, size long")
    assert [tuple(r)[1:] for r in mixing.mixture(blank).collect()] == [(0, 0, 0.0, 0)] * 2


def test_each_source_gives_its_target(spark):
    docs = table(spark, DATA, "documents")
    source = {r.doc_id: r.source for r in docs.collect()}
    sums, goal = Counter(), {}
    for r in mixing.mixture(docs).collect():
        sums[source[r.doc_id]] += r.taken
        goal[source[r.doc_id]] = r.target
    assert all(abs(sums[s] - goal[s]) <= 0.5 for s in goal)


def test_mixed_documents_hold_what_the_mix_takes(spark):
    taken = Counter()
    for r in mixing.mixture(documents(spark)).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed_documents(documents(spark))
    assert out.columns == documents(spark).columns
    words, texts = Counter(), {(d[0], d[1]) for d in DOCUMENTS}
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and r.text
        assert any(d == r.doc_id and t and set(r.text.split()) <= set(t.split()) for d, t in texts)
    assert words == Counter({k: v for k, v in taken.items() if v})
    assert mixing.mixed_documents(no_documents(spark)).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def pieces_of(tokenizer, text, length):
    ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
    cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)] if len(ids) > length else [0, len(ids)]
    return [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def test_ids_are_the_tokenizers(tokenizer):
    odd = ["", "a", "a  b", " a", "a\n\nb", "don't, 'tis.", "x.'s y", "a...b c!?", "\x1cfoo bar\x85", "日本語 テスト", "a <|endoftext|> b",
           "éx", "naïve—test", "‘q’ r’s", "#$%&", "a%'s b", "1,2 3.", "_a_ b_", "α β. γ", "x. Y! z)", "a\tb", "\xa0 a", "a\r\nb"]
    odd += [d[1] for d in DOCUMENTS if d[1]]
    own = packing.Encoder(vocabulary())
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in odd]
    assert own.encode(odd) == want and [own.encode([t])[0] for t in odd] == want


@pytest.mark.parametrize("length", [2_048, 16])
def test_packed_documents(spark, tokenizer, length):
    got = packing.packed_documents(documents(spark), vocabulary(), length).collect()
    want = Counter((d[0], *p) for d in DOCUMENTS for p in pieces_of(tokenizer, d[1], length))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert len(filled) <= -(-sum(r.length for r in got) // length) + 1
    assert packing.packed_documents(no_documents(spark), vocabulary(), length).count() == 0


def smallest(sizes, capacity):
    """Fewest bins, by trying."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [r - sizes[i] * (k == j) for k, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_plans_use_every_piece_and_hardly_more_than_needed():
    r, more, fewest = random.Random(8), 0, 0
    for _ in range(150):
        capacity = r.choice([10, 20, 50])
        sizes = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 11))), reverse=True)
        plan = packing.packing_plan(Counter(sizes), capacity)
        used = Counter()
        for times, members in plan:
            assert times > 0 and sum(s * k for s, k in members) <= capacity
            for s, k in members:
                used[s] += times * k
        assert used == Counter(sizes)
        n, least = sum(t for t, _ in plan), smallest(sizes, capacity)
        more += n - least
        fewest += least
    assert more <= 0.01 * fewest


def test_plan_size_does_not_follow_the_pieces():
    r = random.Random(9)
    counts = {s: r.randint(1, 10**9) for s in range(1, 2_049)}
    plan = packing.packing_plan(counts, 2_048)
    total, sequences = sum(s * c for s, c in counts.items()), sum(t for t, _ in plan)
    assert len(plan) < 10_000 and sequences <= 1.01 * -(-total // 2_048)


def test_lengths_out_of_range(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 0)], "doc_id long, piece int, length long"), 10)


def test_pipeline_stages(spark):
    docs = table(spark, DATA, "documents")
    names, rows, done = docs.columns, docs.count(), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, DATA), name)
        done.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == names
    found, lines, near, mixed, packed = done
    assert found.count() == lines.count() == rows  # all have letters
    ids = {r.doc_id: r.text for r in lines.collect()}
    kept = {r.doc_id: r.text for r in near.collect()}
    assert all(ids[d] == t for d, t in kept.items()) and sum(not t for t in kept.values()) <= 1
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert abs(words(mixed) - 1.5 * words(near)) <= 20
    whole = corpus_pipeline.run(spark, DATA)
    key = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(whole) == key(packed)


def test_pipeline_of_awkward_rows(spark):
    for docs in (documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, DATA), "stage")
        assert "sequence_id" in docs.columns


def test_three_pieces_are_fixed_together():
    from flowtables.llm.packing import _dominating
    count = lambda sizes: ({s: sizes.count(s) for s in sizes}, sorted(set(sizes)))
    left, sizes = count([50, 31, 18, 17])
    assert _dominating(sizes, left, 50, 31, 50) == 18
    left, sizes = count([50, 31, 25, 25, 18])
    assert _dominating(sizes, left, 50, 31, 50) == 0  # 25 and 25 fill it better
    # 48, 33 and 17 dominate every other set with 48; best fit alone needs a third sequence.
    plan = packing.packing_plan(Counter([17, 48, 27, 28, 43, 33]), 100)
    assert sum(times for times, _ in plan) == 2
    assert Counter(s for times, members in plan for s, k in members for _ in range(times * k)) == Counter([17, 48, 27, 28, 43, 33])


def test_ids_of_random_marks_and_code_are_the_tokenizers():
    tokens = packing.encoder(vocabulary())
    r = random.Random(10)
    plain = [chr(c) for c in [10, *range(32, 127), *range(161, 0x450), *range(0x2010, 0x2050), 0x20ac] if tokens.PLAIN.fullmatch(chr(c))]
    marks = "ab19.,;:!?#$%&*|)-('\"[]{}<>/_`=+ \n"
    texts = ["".join(r.choices(plain, k=r.randint(1, 14))) for _ in range(6_000)]
    texts += ["".join(r.choices(marks, k=r.randint(1, 20))) for _ in range(6_000)]
    texts += ['He said "yes".', "see [1]: and", "f(x)[0].", '(foo("bar"));', '{"a": 1},', "</div>.", "_a_.", "`code`.", "it's, don't. x²; y³)."]
    assert tokens.encode(texts) == [tokens.whole(t) for t in texts]


def test_a_worker_remembers_a_bounded_number_of_units(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 100)
    tokens = packing.Encoder(vocabulary())
    r = random.Random(11)
    texts = [" ".join(f"{r.choice(('Mädchen', 'где', 'no', 'x×', 'qué'))}{r.randint(0, 400)}{r.choice(('', ',', '.).', '-a,b'))}" for _ in range(40))
             + f"\n{i}, été, раз! 3×, ÷." for i in range(60)]
    for part in (texts, texts[:3], *([t] for t in texts)):
        assert tokens.encode(part) == [tokens.whole(t) for t in part]
    sizes = [len(x) for x in vars(tokens).values() if isinstance(x, dict)]
    assert sum(sizes) <= 2_000  # the last batch's units may go beyond the bound, and no third half stays


def test_memory_of_units_fits_a_worker():
    tokens, r = packing.Encoder(vocabulary()), random.Random(12)
    for _ in range(3):  # 1.2 million distinct units
        tokens.encode([" ".join("".join(r.choices("etaoinshrdlu", k=9)) for _ in range(400_000))])
    held = [x for m in vars(tokens).values() for x in ([m] if isinstance(m, dict) else [v for v in getattr(m, "__dict__", {}).values() if isinstance(v, dict)])]
    assert sum(map(len, held)) <= 900_000


def test_a_worker_keeps_no_units_after_its_task(spark):
    from pyspark.sql import functions as F

    def held(frames):
        tokens = packing.encoder(vocabulary())
        list(frames)
        yield pd.DataFrame({"n": [len(tokens.recent) + len(tokens.older)]})

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id", F.lit(" and more")).alias("text"))
    assert packing.tokenized_pieces(docs, vocabulary()).count() == 400
    assert docs.mapInPandas(held, "n long").agg(F.max("n")).first()[0] == 0
