"""The language model: exact counts and base, a slow copy of the scoring, proper probabilities."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import TESTDATA
from parcelmart.llm import context_mixing as m
from parcelmart.llm import queries

SCHEMA = "doc_id long, text string, score string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))] + [m.END]


def teaching(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2


def counts(rows):
    return Counter(t for doc_id, text in rows if teaching(doc_id) for t in tokens(text))


def base(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score."""
    c = counts(rows)
    n, v = sum(c.values()), len(c)
    out = []
    for doc_id, text in rows:
        own = tokens(text)
        out.append((doc_id, not teaching(doc_id), len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)))
    return out


M64 = (1 << 64) - 1


def contexts_of(own):
    """(place, hash) of the sampled contexts of a document's words, and all hashes with the end's."""
    hashes, out = [m.word_hash(w) for w in own], []
    for i in range(3, len(own) - 1):
        x = 0
        for back in (1, 2, 3):
            x = (x * int(m._MIX) + hashes[i - back]) & M64
        x = (x ^ x >> 29) * int(m._NODE) & M64
        if x >> 32 & m.SAMPLED - 1 == 0:
            out.append((i, x))
    return out, [(h & 0xFFFFFFFF) % m.MARKS + 1 for h in hashes]


def continuations(rows):
    """Of every sampled context the smallest and the largest (doc_id, what follows) in teaching documents."""
    found = {}
    for doc_id, text in rows:
        if teaching(doc_id):
            at, hashes = contexts_of(tokens(text))
            for (i, x), stop in zip(at, [*(i for i, _ in at[1:]), len(hashes)], strict=False):
                after = hashes[i : min(stop, i + m.NEXT)]
                found.setdefault(x, []).append(((doc_id is not None, doc_id or 0), np.array(after, "<u2").tobytes()))
    return {x: (min(f), max(f)) for x, f in found.items()}


def log2(x):
    return min(int(math.log2(x + 1)), m.PLACES - 1)


def slow_document(doc_id, own, c, spelling, begin, follows):
    """The same bits, one by one, with a dictionary of cells."""
    mine = Counter(own) if teaching(doc_id) else Counter()
    known, total = {w: c[w] - mine[w] for w in set(own)}, sum(c.values()) - sum(mine.values())
    at, hashes = contexts_of(own)
    copied = [0] * len(own)
    for i, x in at:
        sources = [after for key, after in follows.get(x, ()) if key != (doc_id is not None, doc_id or 0)]
        if sources:
            for k, h in enumerate(np.frombuffer(sources[0], "<u2").tolist()):
                if i + k < len(own):
                    copied[i + k] = h
    p, worth = {}, {}
    weights = {(kind, place): list(m.FIRST_WEIGHTS[kind]) for kind in range(3) for place in range(4)}

    def coded(kind, contexts, place, bit):
        cells = [int(m._STARTS[4 * kind + j]) + x for j, x in enumerate(contexts)]
        guess = [p.get(x, begin[0][x]) for x in cells]
        stretched = [math.log(g / (1 - g)) for g in guess]
        w = weights[kind, log2(place) // m.GATE_SPAN]
        chance = 1 / (1 + math.exp(-max(-9, min(9, sum(a * b for a, b in zip(w, stretched, strict=True))))))
        for j, x in enumerate(cells):
            w[j] += m.DOC_RATE * (bit - chance) * stretched[j]
            seen = worth.get(x, begin[1][x])
            p[x] = min(max(guess[j] + (bit - guess[j]) / (seen + 1.5), 1e-3), 1 - 1e-3)
            worth[x] = min(seen + 1, m.MOST_WORTH)
        return math.log10(chance if bit else 1 - chance)

    score, seen, mass, classes, hits = 0.0, Counter(), 0, [], []
    for i, w in enumerate(own):
        last = sum(4**k * (classes[-k - 1] if i > k else 0) for k in range(3))
        repeats = sum(3**k * ((1 + (classes[-k - 1] == 1)) if i > k else 0) for k in range(3))
        counted = log2(max(known[own[i - 1]], 0)) if i else 0
        hashed = hashes[i - 1] % m.HASHED if i else 0
        run = 0
        while run < min(i, m.RUNS - 1) and hits[-run - 1]:
            run += 1
        hit = copied[i] != 0 and copied[i] == hashes[i]
        if copied[i]:
            score += coded(m.COPIED, (run, log2(i), last, hashed), i, hit)
        if not hit:
            again, unseen = seen[w] > 0, total - mass
            if i:
                score += coded(m.REPEATED, (log2(i), repeats, counted, hashed), i, again)
            if again:
                score += math.log10(seen[w] / i)
            else:
                if unseen > 0:
                    score += coded(m.KNOWN, (log2(i), last, counted, hashed), i, known[w] > 0)
                score += math.log10(known[w] / unseen) if known[w] > 0 and unseen > 0 else spelling[w]
        classes.append(1 if seen[w] else 2 if known[w] > 0 else 3)
        mass += 0 if seen[w] else known[w]
        seen[w] += 1
        hits.append(hit)
    return score


def test_query_against_brute_force(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in queries.op6_context_mixing(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for doc_id, *rest, score in base(rows):
        assert list(found[doc_id][1:5]) == rest
        assert abs(found[doc_id].base_score - score) < 1e-6 * abs(score)
    # The same model, document by document.
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = m.stage(m.tokenize(docs), "test-tokens", partition_by="kind")
    vocab = m.vocabulary(m.stage(m.counted(marked), "test-counts"))
    words = {bytes(r.word): r.log10_p for r in m.spelled(vocab, m.learn(vocab)).collect()}
    c = counts(rows)
    within = Counter(t for doc_id, text in rows if teaching(doc_id) for t in set(tokens(text)))
    assert {bytes(r.word): (r.n, r.documents) for r in vocab.where("n > 0").collect()} == {w: (c[w], within[w]) for w in c}
    begin = m.first_cells(m.repeat_rates(marked), sum(n == 1 for n in within.values()) / sum(within.values()))
    assert sum(len(contexts_of(tokens(t))[0]) for _, t in rows) == marked.where(m.F.col("kind") == m.CONTEXT).count() > 500
    follows = continuations(rows)
    for doc_id, text in rows[::9]:
        expected = slow_document(doc_id, tokens(text), c, words, begin, follows)
        assert abs(found[doc_id].score - expected) < 1e-2 + 1e-4 * abs(expected)
    held = [r for r in found.values() if r.held_out]
    total_bytes = sum(len((t or "").encode()) for d, t in rows if not teaching(d))
    assert -sum(r.score for r in held) * math.log2(10) / total_bytes < 2.1
    # Better than the base, which gives every unknown word the share of one.
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(0 < r.bits_per_byte for r in held if r.n_tokens > 1)


def test_vectorised_counts_and_spelling_equal_loops():
    words = [b"the", b"then", b"a", "é".encode(), m.END, b"long" * 30]
    counted = np.array([5, 2, 9, 1, 4, 1])
    model = m.Model()
    m.count_bits(model, words, counted)
    speller = m.Speller(model)
    got = speller(words)
    for word, value in zip(words, got, strict=True):
        total = 0.0
        for at, symbol in enumerate(word + b" "):
            context = [0] * len(m.TABLE_BITS)
            wide = [b + 1 for b in (word + b" ")[:at]]
            packed = 0
            for order in range(1, 5):
                packed = packed << 9 | (wide[at - order] if order <= at else 0)
                context[order - 1] = packed
            context[4] = sum(b * pow(m._POWER, i + 1, 1 << 64) for i, b in enumerate(wide)) & (1 << 64) - 1
            for k in range(8):
                node = np.array([1 << k | symbol >> (8 - k)])
                slot = m.slots([np.array([x], np.uint64) for x in context], node)
                inputs = [float(t[s[0]]) for t, s in zip(speller.tables, slot, strict=True)]
                weight = speller.weights[k * m.LEVELS + sum(x != 0 for x in inputs)]
                x = sum(float(w) * x for w, x in zip(weight, inputs, strict=True))
                bit = symbol >> (7 - k) & 1
                total += math.log10(1 / (1 + math.exp(-x if bit else x)))
        assert abs(total - value) < 1e-4 * max(1, abs(total))


def drawn_words(seed, size):
    draw = np.random.default_rng(seed)
    return sorted({b"".join(draw.choice([b"th", b"er", "é".encode(), b"a"], draw.integers(1, 6))) for _ in range(size)}, key=zlib.crc32)


def test_words_that_begin_alike_share_their_bits(monkeypatch):
    """Counting and spelling look a beginning up once, whatever the order of the words, with the results of each word alone."""
    words = drawn_words(2, 300) + [m.END]
    distinct = {(w + b" ")[: k + 1] for w in words for k in range(len(w) + 1)}
    words.append(b"z" * 70_000)
    counted = np.arange(len(words), 0, -1)
    together, alone = m.Model(), m.Model()
    m.count_bits(together, words, counted)
    for begin in range(0, len(words), 50):
        m.count_bits(alone, words[begin : begin + 50], counted[begin : begin + 50])
    for k in range(len(m.TABLE_BITS)):
        assert (together.seen[k] == alone.seen[k]).all() and (together.ones[k] == alone.ones[k]).all()
        assert together.seen[k].sum(dtype=float) == 8 * sum(n * (len(w) + 1) for w, n in zip(words, counted.tolist(), strict=True))
    looked_up, totals = [], m.Speller.bit_totals
    speller = m.Speller(together)
    one_by_one = [float(speller([w])[0]) for w in words]
    monkeypatch.setattr(m.Speller, "bit_totals", lambda self, flat, contexts: looked_up.append(len(flat)) or totals(self, flat, contexts))
    assert speller(words).tolist() == one_by_one
    assert sum(looked_up) == len(distinct) + 70_001 < sum(len(w) + 1 for w in words)
    assert speller([]).tolist() == [] and speller([words[3]] * 2).tolist() == [one_by_one[3]] * 2


def test_predictions_without_the_token_itself():
    """One table per bit gives what taking the token off its slot gives."""
    words = drawn_words(3, 200)
    model = m.Model()
    m.count_bits(model, words, np.ones(len(words)))
    tables = m.without_one(model)
    flat, _, _, contexts = m.symbols(words)
    for _, node, bit in m.bits(flat):
        for n, slot in enumerate(m.slots(contexts, node)):
            ones = np.maximum(model.ones[n][slot] - bit, 0)
            expected = m._stretched(ones, np.maximum(model.seen[n][slot] - 1, ones))
            assert (tables[n][2 * slot.astype(np.int64) + bit] == expected).all()
    assert (m.learn_weights(model, words, np.ones(len(words)), tables) == m.learn_weights(model, words, np.ones(len(words)))).all()


@pytest.mark.parametrize("spread", [1, 1 << 40])
def test_earlier_against_loops(spread):
    draw = np.random.default_rng(4)
    doc, ids = np.sort(draw.integers(0, 9, 500)), draw.integers(0, 12, 500) * spread
    before, total = m.earlier(doc, ids)
    pairs, seen = list(zip(doc.tolist(), ids.tolist(), strict=True)), Counter()
    whole = Counter(pairs)
    for k, pair in enumerate(pairs):
        assert (before[k], total[k]) == (seen[pair], whole[pair])
        seen[pair] += 1


def test_words_of_a_chunk_are_numbered_as_they_come():
    texts = [["b a", "", None], ["É a c"], [None], ["c b d"]]
    chunk = m.Chunk(5, 3, contexts=False)
    for k, part in enumerate(texts):
        chunk.add(m.pa.record_batch({"doc_id": [10 * k + i for i in range(len(part))], "held_out": [False] * len(part), "text": m.pa.array(part, m.pa.string())}))
    rows = m.pa.Table.from_batches(chunk.rows())
    words, hashes = m._chunk_words(rows.filter(m.pc.equal(rows.column("kind"), m.LISTED)))
    assert words == [m.END, b"b", b"a", "É".encode(), b"c", b"d"]
    assert hashes.tolist() == [m.word_hash(w) for w in words]
    ids, sizes = m._word_numbers(rows.filter(m.pc.equal(rows.column("kind"), m.DOCUMENT)).sort_by("slot"))
    assert (ids.tolist(), sizes.tolist()) == ([1, 2, 3, 2, 4, 4, 1, 5], [2, 0, 0, 3, 0, 3])


def test_documents_side_by_side_equal_documents_alone():
    """Of documents of any lengths, beyond the bits that are looked up at once."""
    draw = np.random.default_rng(6)
    sizes = np.array([0, 3, 200, 1, 77, 16, 33])
    facts = m.Facts(draw.integers(0, 9, 40), np.log10(draw.random(40)), np.arange(40, dtype=np.uint16) + 1, 900)
    documents = [np.append(draw.integers(1, 40, n), 0) for n in sizes]
    copied = [np.where(draw.random(len(ids)) < 0.3, facts.marks[ids], draw.integers(0, 3, len(ids))).astype(np.uint16) for ids in documents]
    held, begin = draw.random(len(sizes)) < 0.5, m.first_cells({0: (1, 3)}, 0.2)
    whole = m.document_scores([m.document_bits(np.concatenate(documents), sizes, held, np.concatenate(copied), facts)], begin)
    for k in range(len(sizes)):
        one = m.document_scores([m.document_bits(documents[k], sizes[k : k + 1], held[k : k + 1], copied[k], facts)], begin)
        assert abs(one[0] - whole[k]) < 1e-6 * max(1, abs(one[0]))


def test_bits_make_a_distribution_over_bytes():
    model = m.Model()
    m.count_bits(model, [b"the", b"that", b"of"], np.array([5, 3, 2]))
    speller = m.Speller(model)
    first = []
    for byte in range(256):
        flat, _, _, contexts = m.symbols([bytes([byte])])
        cost = 1.0
        for bit, total in speller.bit_totals(flat, contexts):
            cost *= 1 / (1 + math.exp(-total[0] if bit[0] else total[0]))
        first.append(cost)
    assert abs(sum(first) - 1) < 1e-4


def test_weights_learn(spark):
    """After learning, held-out words cost less than with the first weights."""
    draw = np.random.default_rng(1)
    words = sorted({b"".join(draw.choice([b"th", b"er", b"on", b"an", b"re"], 5)) for _ in range(1000)})
    known, new = [w for i, w in enumerate(words) if i % 5], words[::5]
    model = m.Model(weights=np.full((m.GATES, len(m.TABLE_BITS)), 0.05))
    m.count_bits(model, known, np.ones(len(known)))
    before = m.Speller(model)(new).sum()
    model.weights = m.learn_weights(model, known * 20, np.ones(20 * len(known)))
    assert m.Speller(model)(new).sum() > before


def reversed_words(text):
    return " ".join(reversed((text or "").split()))


def test_word_order_counts(spark):
    """Held-out documents read backwards cost more."""
    rows = spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet")).select("doc_id", "text").collect()
    turned = [(d, reversed_words(t) if not teaching(d) else t) for d, t in rows]
    sums = [m.scored(spark.createDataFrame(r, "doc_id long, text string")).where("held_out").agg({"score": "sum"}).first()[0] for r in (rows, turned)]
    assert sums[1] < 1.05 * sums[0]


def test_copies_cost_less_and_documents_do_not_teach_themselves(spark):
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(draw.choice(words, 300)) for _ in range(40)]
    teachers = [i for i in range(200) if teaching(i)][:40]
    held = [i for i in range(1000, 1200) if not teaching(i)][:2]
    rows = [*zip(teachers, texts, strict=True), (held[0], texts[0]), (held[1], " ".join(draw.choice(words, 300))), (5000 if teaching(5000) else 5001, texts[1])]
    bits = {r.doc_id: r.bits_per_byte for r in m.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    alone = np.median([bits[i] for i in teachers[2:]])
    # Copies of a teaching document, held out or teaching; the document copied knows its copy if that teaches.
    assert bits[held[0]] < 0.85 * alone and bits[rows[-1][0]] < 0.85 * alone and bits[teachers[1]] < 0.85 * alone
    assert abs(bits[held[1]] / alone - 1) < 0.1 and abs(bits[teachers[0]] / alone - 1) < 0.1


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    rows = spark.read.parquet(str(TESTDATA / "sf0.001" / "documents.parquet")).select("doc_id", "text")
    whole = {r.doc_id: r.score for r in m.scored(rows.repartition(1)).collect()}
    for name, size in (("SIDE_BY_SIDE", 7), ("MIXED_TOKENS", 900), ("PART_BYTES", 5000), ("CHUNK_BYTES", 60_000), ("LISTED_WORDS", 100)):
        monkeypatch.setattr(m, name, size)
    found = [whole, {r.doc_id: r.score for r in m.scored(rows.repartition(9)).collect()}]
    assert found[0].keys() == found[1].keys()
    assert all(abs(found[0][k] - found[1][k]) < 1e-6 * abs(found[0][k]) for k in found[0])


@pytest.mark.parametrize("begin", [[], [1], [3], [1, 2, 1, 3], [4, 1, 2, 2, 1, 0, 3]])
@pytest.mark.parametrize("copied", [0, 6, 9])
def test_the_next_token_has_a_distribution(begin, copied):
    """The chances of all tokens a text can go on with add up to 1 at most, and to nearly that."""
    count = np.array([4, 6, 3, 0, 1])
    spelling = np.log10([0.1, 0.2, 0.2, 0.3, 0.1])
    facts = m.Facts(count, spelling, np.array([5, 6, 7, 8, 9], np.uint16), int(count.sum()))

    def chance(*ids):
        next_copied = np.array([0] * (len(ids) - 1) + [copied if len(ids) > len(begin) else 0], np.uint16)
        bits = m.document_bits(np.array(ids), np.array([len(ids) - 1]), np.array([True]), next_copied, facts)
        return 10 ** float(m.document_scores([bits], m.first_cells({}, 0.2))[0])

    before = chance(*begin) if begin else 1.0
    total = sum(chance(*begin, token) for token in range(5)) / before
    # A word that a copy has is also among the others, and known words can be spelled: both cost a little.
    assert 0.3 < total < 1 + 1e-6


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (None, "no id É"), (5, "Word word WORD"), (6, "x" * 200_000), (7, "w " * 50_000), (8, "same text"), (8, "same text")]
    found = m.scored(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    expected = sorted(base(rows), key=str)
    got = sorted((tuple(r)[:6] for r in found), key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert all(abs(g[5] - e[5]) < 1e-6 * abs(e[5]) for g, e in zip(got, expected, strict=True))
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert len({r.score for r in found if r.doc_id == 8}) == 1


def test_nothing_to_learn_from_and_empty_table(spark):
    held = next(i for i in range(100) if not teaching(i))
    one = m.scored(spark.createDataFrame([(held, "a b", "x")], SCHEMA)).collect()
    assert (one[0].n_known, one[0].train_tokens, one[0].base_score) == (0, 0, 0.0)
    assert m.scored(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_copy_of_a_short_document_counts(spark):
    """Contexts of all documents are known, also of those too short for a sample of contexts."""
    draw = np.random.default_rng(7)
    words = [f"w{i}" for i in range(300)]
    teachers = [i for i in range(1000) if teaching(i)]
    twice = [" ".join(draw.choice(words, 12)) for _ in range(60)]
    once = [" ".join(draw.choice(words, 12)) for _ in range(60)]
    rows = list(zip(teachers, [*twice, *twice, *once], strict=False))
    scores = {r.doc_id: r.score for r in m.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    copied, alone = ([scores[i] for i, _ in part] for part in (rows[:120], rows[120:]))
    assert min(copied) > max(alone)


def test_copies_against_loops(spark, monkeypatch):
    """What follows all contexts, over chunks, parts, repeated and null ids."""
    monkeypatch.setattr(m, "BYTES_PER_PART", 300)
    draw = np.random.default_rng(8)
    texts = [" ".join(draw.choice(["a", "b", "c", "É"], draw.integers(0, 12))) for _ in range(300)]
    rows = [(None if i % 50 == 0 else int(draw.integers(-60, 150)), t) for i, t in enumerate(texts)]
    marked = m.stage(m.tokenize(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), contexts=False), "test-tokens", partition_by="kind")
    assert marked.where(m.F.col("kind") == m.CONTEXT).count() == 0
    told, tokens_of = m.copies(marked).toArrow(), marked.toArrow()
    follows, seen = continuations(rows), 0
    for chunk in set(tokens_of.column("chunk").to_pylist()):
        own = tokens_of.filter(m.pc.equal(tokens_of.column("chunk"), chunk))
        documents = own.filter(m.pc.equal(own.column("kind"), m.DOCUMENT)).sort_by("slot")
        words, hashes = m._chunk_words(own.filter(m.pc.equal(own.column("kind"), m.LISTED)))
        ids, sizes = m._word_numbers(documents)
        found = told.filter(m.pc.equal(told.column("chunk"), chunk))
        got = m.predicted(ids, sizes, documents.column("doc_id"), documents.column("held_out").to_numpy(), hashes, found).tolist()
        at = 0
        for doc_id, size in zip(documents.column("doc_id").to_pylist(), sizes.tolist(), strict=True):
            text = [words[i] for i in ids[at : at + size]] + [m.END]
            expected = [0] * len(text)
            for i, x in contexts_of(text)[0]:
                sources = [after for key, after in follows.get(x, ()) if key != (doc_id is not None, doc_id or 0)]
                for k, h in enumerate(np.frombuffer(sources[0], "<u2").tolist() if sources else ()):
                    if i + k < len(text):
                        expected[i + k] = h
            assert got[: len(text)] == expected
            got, at, seen = got[len(text) :], at + size, seen + 1
    assert seen == len(rows)
