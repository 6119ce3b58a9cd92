"""The operators against brute force, exact round trips and held-out labels."""

from __future__ import annotations

import random
import re
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from lakelayer.llm import (decontaminate, language_id, lm_score, near_dup, partenum, pieces, pii, quality, repeats,  # noqa: E402
                           shingles, substring_dedup)
from lakelayer.llm.components import components  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_base_spans_equal_plain_search(documents):
    rnd = random.Random(1)
    made = ["".join(rnd.choice("a@.-_%1 29+(0") for _ in range(rnd.randint(0, 30))) for _ in range(30_000)]
    made += ["a@b.c_d@e.f 1.2.3.4.5.6.7.8 +12 (34) 567.89-0 4111 1111 1111 1111", "9" * 5000, "+" * 3000, "a" * 5000 + "@"]
    for t in made + [t or "" for _, t in documents[1]]:
        assert pii.base_spans(t) == brute.base_spans(t), t


def test_terms_that_disclose_an_entity_are_marked(make_docs):
    near = [(i, f"filler words number {i} come here zanzibar writes to ann@x.org about plain things") for i in range(5)]
    far = [(i, "filler words number come here about plain things writes to nobody " * 30) for i in range(10, 40)]
    got = {r["doc_id"]: r for r in pii.sanitisation_spans(make_docs(near + far)).collect()}
    for i, text in near:
        kinds = {(x["kind"], text[x["s"]:x["e"]]) for x in got[i]["added"]}
        assert kinds == {("remove", "zanzibar")}
        assert [(x["kind"], text[x["s"]:x["e"]]) for x in got[i]["base"]] == [("email", "ann@x.org")]
    assert all(not got[i]["added"] for i, _ in far)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised_texts(make_docs(near + far)).collect()}
    assert clean[0] == "filler words number 0 come here  writes to [EMAIL] about plain things" and clean[10] == far[0][1]


@pytest.mark.parametrize("term", ["İstanbul", "ΟΔΟΣ'Α", "zanzibar"])
def test_terms_are_lowered_alike_when_counted_and_when_met(make_docs, term):
    docs = [(i, f"{term} writes ann@x.org") for i in range(5)] + [(10 + i, "some plain words of no one here") for i in range(40)]
    got = {r["doc_id"]: r["added"] for r in pii.sanitisation_spans(make_docs(docs)).collect()}
    first = pii._TERM.search(term).group()
    assert all((0, len(first)) in {(x["s"], x["e"]) for x in got[i]} for i in range(5))


def test_disclosing_terms_are_marked_wherever_they_occur(make_docs):
    filler = " filler words number come here about plain things writes to nobody" * 30
    docs = [(i, f"filler words number {i} come here zanzibar writes to ann@x.org about plain things") for i in range(5)]
    docs += [(5, "Zanzibar again" + filler + " zanzibar mailto:ann@x.org" + filler + " ZANZIBAR zanzibars"), (6, f"no name but zanzibar{filler}"),
             (7, "Zanzibar"), (8, "zanzibar@x.org"), (None, "zanzibar"), (7, "Zanzibar")]
    docs += [(i, filler) for i in range(10, 40)]
    whole = re.compile(r"\bzanzibar\b(?!@)", re.IGNORECASE)
    want = sorted((str(d), "generalise", *m.span()) for d, t in docs for m in whole.finditer(t))
    assert len(want) == 12
    got = pii.sanitisation_spans(make_docs(docs)).collect()
    assert len(got) == len(docs)
    assert sorted((str(r["doc_id"]), x["kind"], x["s"], x["e"]) for r in got for x in r["added"]) == want


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(documents, order):
    df, rows = documents
    got = {r["doc_id"]: tuple(r)[1:] for r in lm_score.score_documents(df, order=order, prior=30.0).collect()}
    want = brute.lm_scores(rows, order, 30.0)
    assert got.keys() == want.keys()
    for d in want:
        assert got[d][:4] == want[d][:4] and got[d][4:] == pytest.approx(want[d][4:], abs=1e-6)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_automaton_walked_arc_by_arc(order):
    """States, arcs and failure arcs against the formula, for learned and unknown words; pieces stand where whole texts do."""
    import math
    from collections import Counter

    import numpy as np

    rnd = random.Random(order)
    learned = [" ".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 12))) for _ in range(40)]
    asked = learned[:5] + ["", "z", "a z b a b c", "a b c d e " * 300]
    seen = Counter()
    for t in learned:
        w = ["<s>", *t.split(), "</s>"]
        for k in range(1, order + 1):
            seen.update(tuple(w[i - k + 1:i + 1]) for i in range(max(1, k - 1), len(w)))
    tokens = lm_score.Tokens(asked, order)
    told = [np.zeros(len(g), np.int64) for g in tokens.grams]
    everything = [w for t in asked for w in [*t.split(), "</s>"]]
    place = np.arange(len(everything)) - np.repeat(tokens.heads, tokens.sizes)
    for k in range(1, order + 1):
        for i in np.flatnonzero(tokens.there[k - 1]):
            gram = ["<s>"] * int(place[i] == k - 2) + everything[max(i - k + 1, i - place[i]):i + 1]
            told[k - 1][tokens.which[k - 1][i]] = seen[tuple(gram)]
    n, v, prior = sum(c for g, c in seen.items() if len(g) == 1), sum(len(g) == 1 for g in seen), 7.0
    machine = lm_score.Automaton(tokens, told, n, v, prior)
    seen[("<s>",)] = len(learned)

    def share(history, word):
        p = (seen[(word,)] + 0.5) / (n + 0.5 * (v + 1))
        for k in range(1, len(history) + 1):
            p = (seen[(*history[-k:], word)] + prior * p) / (seen[tuple(history[-k:])] + prior)
        return p

    arcs = dict(zip(machine.key.tolist(), zip(machine.weight.tolist(), machine.to.tolist())))
    assert len(arcs) == len(machine.key)
    history_of, failed = {}, 0  # a state stands for one history, however it is reached
    at, whole = 0, machine.traverse(tokens)
    for t in asked:
        state, before = machine.begin, ["<s>"]
        for w in [*t.split(), "</s>"]:
            longest = next((tuple(before[-k:]) for k in range(min(order - 1, len(before)), 0, -1) if seen[tuple(before[-k:])]), ())
            assert history_of.setdefault(state, longest) == longest
            weight, word = 0.0, int(tokens.which[0][at])
            while state * machine.words + word not in arcs:
                weight, state, failed = weight + machine.fail_weight[state], int(machine.fail[state]), failed + 1
            arc, state = arcs[state * machine.words + word]
            want = math.log10(share(before[-(order - 1):] if order > 1 else [], w))
            assert weight + arc == pytest.approx(want, abs=1e-9) and whole[at] == pytest.approx(want, abs=1e-9)
            before.append(w)
            at += 1
        assert state == machine.begin
    assert at == len(whole) and (failed > 0) == (order > 1) and len(set(history_of.values())) == len(history_of)
    for piece in (1, 2, 7, 10_000):
        assert np.array_equal(machine.traverse(tokens, piece), whole)


def test_encoding_is_the_library_s(documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    model = pieces.read_model()
    encoder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    rnd = random.Random(3)
    made = ["", " ", "a  b", "▁a", "a\nb", "<s> x", "\x00z", "日本\U0001f600", "x" * 3000, "ab" * 2000 + " " * 300 + "é" * 99,
            "\t\t  \n;\r\n"]
    made += ["".join(rnd.choice("abetionhs  \n▁é日;\r") for _ in range(rnd.randint(0, 150))) for _ in range(1500)]
    for batch in (made, [t or "" for _, t in documents[1]], made[::-1]):
        ids, offsets = encoder.encode(batch)
        back = decoder.decode(ids, offsets)
        for t, a, b, want, data in zip(batch, offsets, offsets[1:], library.encode(batch, num_threads=1), back):
            assert ids[a:b].tolist() == want, t
            assert data == t.replace(pieces.MARK, " ").encode()


def test_encoded_documents_round_trip(documents):
    df, rows = documents
    got = pieces.encoded(df).collect()
    assert len(got) == len(rows) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_hamming_index_finds_all_within_the_radius():
    import numpy as np

    rnd = np.random.default_rng(2)
    stored = rnd.integers(0, 2**64, 300, dtype=np.uint64)
    queries = np.concatenate([stored[:100] ^ (np.uint64(1) << rnd.integers(0, 64, 100, dtype=np.uint64)) ^
                              (np.uint64(1) << rnd.integers(0, 64, 100, dtype=np.uint64)), rnd.integers(0, 2**64, 500, dtype=np.uint64)])
    for radius in (0, 3, 7, 25):
        q, s = decontaminate.HammingIndex(stored, radius).near(queries)
        near = np.bitwise_count(queries[:, None] ^ stored[None]) <= radius
        assert sorted(zip(q.tolist(), s.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(near))))


def test_leaks(spark, documents, make_docs):
    df, rows = documents
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = brute.leaks(rows, items)
    for block in (decontaminate.BLOCK_ITEMS, 15):  # one pass, and one per block of items
        found = decontaminate.find_leaks(df, bench, block_items=block).collect()
        assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found} == pytest.approx(want)
    # every size of item, at every place, with the ends cut or changed
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    made = [(n, " ".join(word() for _ in range(n))) for n in (1, 2, 4, 5, 6, 9, 12, 17, 25, 40, 60, 100, 300)]
    docs = []
    for n, text in made:
        w = text.split()
        for k in range(12):
            cut = w[1:] if n > 20 and k % 3 == 1 else w[:-1] + ["end"] if n > 20 and k % 3 == 2 else w
            docs.append((n * 100 + k, " ".join([word() for _ in range(rnd.randint(0, 40))] + [x.upper() for x in cut] +
                                               [word() for _ in range(rnd.randint(0, 40))])))
    items = spark.createDataFrame(made, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(make_docs(docs), items).collect()}
    assert found == pytest.approx(brute.leaks(docs, made))


def test_leaks_with_edits_at_every_place():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    items, docs = [], []
    # (words, edited words in a row, words to draw from: few words make repeated shingles)
    for n, edited, words in [(50, 1, 0), (60, 2, 0), (100, 6, 0), (120, 8, 0), (200, 16, 0), (200, 17, 0), (30, 0, 4), (60, 2, 12),
                             (100, 6, 3), (150, 4, 40)]:
        few = [word() for _ in range(words)]
        draw = (lambda: rnd.choice(few)) if words else word  # noqa: B023
        w = [draw() for _ in range(n)]
        items.append((len(items), " ".join(w)))
        made = [w[:a] + [word() for _ in range(edited)] + w[a + edited:] for a in range(n - edited + 1)]
        made += [w[a:] + w[:a] for a in range(1, n, 7)]  # two parts in the other order
        for _ in range(40):  # scattered edits: other words, lost words, new words
            v = list(w)
            for _ in range(rnd.randint(1, 5)):
                a = rnd.randrange(len(v))
                v[a: a + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 1)
            made.append(v)
        docs += [" ".join([word() for _ in range(rnd.randint(0, 30))] + v + [word() for _ in range(rnd.randint(0, 30))]) for v in made]
    found = {(d, i): (s, a) for d, i, s, a in decontaminate.ItemIndex(items).leaks(docs)}
    shingled = [(i, decontaminate.words_of(t)) for i, t in items]
    want = {}
    for d, t in enumerate(docs):
        w = decontaminate.words_of(t)
        grams = decontaminate.shingles(w)
        for i, item in shingled:
            if sum((grams & decontaminate.shingles(item)).values()) < 0.6 * (len(item) - 4):
                continue  # too little in the whole text
            s, a = max((decontaminate.similarity(decontaminate.shingles(w[a: a + len(item)]), decontaminate.shingles(item)), -a)
                       for a in range(max(1, len(w) - len(item) + 1)))
            if s >= 0.8:
                want[d, i] = (s, -a)
    lost = want.keys() - found.keys()
    assert len(want) > 800 and not lost, f"{len(lost)} of {len(want)} leaks lost"
    assert found == want


def test_partenum_need_is_a_bound_for_small_sets():
    import numpy as np

    rnd = np.random.default_rng(7)
    below, similar = 0, 0
    for size in range(12, 41):
        elements, sizes = [], []
        for _ in range(600):  # pairs: a set, and one with elements lost and new ones
            base = np.unique(rnd.integers(0, 2**64, size, dtype=np.uint64))
            drop, add = rnd.integers(0, size // 8 + 2, 2)
            other = np.unique(np.concatenate([rnd.permutation(base)[drop:], rnd.integers(0, 2**64, add, dtype=np.uint64)]))
            elements += [base, other]
            sizes += [len(base), len(other)]
        sizes = np.array(sizes)
        signed = [{} for _ in elements]  # per set and band: signatures and need
        for band, index in partenum.Bands(int(sizes.max())).signing(sizes):
            sig, own, need = partenum.sign(band, np.concatenate([elements[i] for i in index]), sizes[index])
            for i, n in zip(index, need):
                signed[i][band.number] = (set(), int(n))
            for x, o in zip(sig.tolist(), own.tolist()):
                signed[index[o]][band.number][0].add(x)
        for i in range(0, len(elements), 2):
            common = len(np.intersect1d(elements[i], elements[i + 1]))
            if 100 * common >= 80 * (sizes[i] + sizes[i + 1] - common):
                similar += 1
                larger = max(signed[i], signed[i + 1], key=lambda x: min(x))
                (a, a_need), (b, b_need) = signed[i][min(larger)], signed[i + 1][min(larger)]
                below += len(a & b) < max(a_need, b_need, 1)
    assert similar > 5000 and not below, f"{below} of {similar} similar pairs share fewer than need"


def test_partenum_never_misses_a_similar_pair():
    import numpy as np

    rnd = np.random.default_rng(6)
    elements, sizes, sets = [], [], []
    for size in [*range(1, 60), 80, 120, 200, 333, 500]:
        base = rnd.integers(0, 2**64, size, dtype=np.uint64)
        for _ in range(6):
            drop, add = rnd.integers(0, size // 8 + 2), rnd.integers(0, size // 8 + 2)
            s = np.unique(np.concatenate([base[min(drop, size - 1):], rnd.integers(0, 2**64, add, dtype=np.uint64)]))
            elements.append(s)
            sizes.append(len(s))
            sets.append(set(s.tolist()))
    sizes = np.array(sizes)
    signed = [dict() for _ in sets]  # per set: signature -> need in its band
    for band, index in partenum.Bands(int(sizes.max())).signing(sizes):
        sig, own, need = partenum.sign(band, np.concatenate([elements[i] for i in index]), sizes[index])
        for x, o in zip(sig.tolist(), own.tolist()):
            signed[index[o]][x] = int(need[o])
    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                shared = signed[i].keys() & signed[j].keys()
                linked += 1
                assert shared
                # in the band of the larger set, at least as many as either needs
                band = max(x & 255 for x in shared)
                in_band = [x for x in shared if x & 255 == band]
                assert len(in_band) >= max(signed[i][in_band[0]], signed[j][in_band[0]])
    assert linked > 100


def test_near_duplicates(documents, make_docs):
    df, rows = documents
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(df).collect()}
    assert got == brute.components(rows)


def test_near_copies_in_chains_and_large_buckets(make_docs, monkeypatch):
    monkeypatch.setattr(near_dup, "LARGE", 5)
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    rows, passage = [], [word() for _ in range(50)]
    long = [word() for _ in range(400)]
    for i in range(40):  # a chain: each differs from the one before in a tenth of it
        long = long[12:] + [word() for _ in range(12)]
        rows.append((1000 + i, " ".join(long)))
    base = [word() for _ in range(120)]
    for i in range(60):  # near copies, one word changed
        rows.append((i, " ".join(base[:i] + [word()] + base[i + 1:])))
    for i in range(60):  # a passage that many share, with other words of their own
        rows.append((200 + i, " ".join(passage + [word() for _ in range(rnd.randint(5, 90))])))
    rows += [(300 + i, " ".join(passage[:n])) for i, n in enumerate([1, 1, 4, 4, 5, 6, 7, 20, 22, 23, 25, 50, 49, 48])]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(make_docs(rows)).collect()}
    assert got == brute.components(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(200, 260)] + [(500, 499), (499, 500), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(200, 260)}, 500: 499}


def test_shingle_sets_and_ids():
    texts = ["a b c d e f", "A  B\tc d E f", "a b c d", "d c b a", "", "a b c d e f a b c d e f"]
    elements, sizes = shingles.ShingleSets().sets(texts)
    assert sizes.tolist() == [len(brute.shingle_set(t)) for t in texts]
    ids = shingles.set_ids(elements, sizes).tolist()
    assert ids[0] == ids[1] and len(set(ids)) == 5 and ids[4] == 0


def test_remove_repeats(documents):
    df, rows = documents
    out = substring_dedup.remove_repeats(df).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("gone"), F.size("spans").alias("runs"),
        F.sha2("kept", 256).alias("sha"))
    assert {r["doc_id"]: tuple(r)[1:] for r in out.collect()} == brute.remove_repeats(rows)


def test_repeats_of_every_kind(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 300)  # long texts come in pieces
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    rows = [(i, "".join(rnd.choice("abcdefgh é") for _ in range(rnd.randint(0, 200))) + passage[a:a + n] + "".join(
        rnd.choice("xyz") for _ in range(rnd.randint(0, 99))))
        for i, (a, n) in enumerate((rnd.randint(0, 300), rnd.randint(30, 130)) for _ in range(60))]
    rows += [(100, "ab" * 200), (101, "xab" + "ab" * 60), (102, "a" * 49), (103, "a" * 50), (104, "a" * 51), (105, "a" * 300),
             (106, rows[3][1]), (107, "é" * 80), (108, "\x00" * 90), (109, "\x00" * 60 + "b"), (110, None), (111, "")]
    got = {r["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]))
           for r in substring_dedup.remove_repeats(make_docs(rows)).collect()}
    assert got == {d: x[:3] for d, x in brute.remove_repeats(rows).items()}


def test_repeat_groups_list_all_occurrences(make_docs):
    same = "a passage of more than fifty bytes that three documents share, each"
    rows = [(i, f"{'pqr'[i] * (i + 3)}{same}{'xyz'[i] * 7}") for i in range(3)]
    rows.append((7, "p" * 3 + same + "w"))  # shares one byte more to the left with the first
    groups = {}
    for r in substring_dedup.repeat_groups(make_docs(rows)).collect():
        groups.setdefault((r["part"], r["number"]), []).append((r["doc_id"], r["start"], r["length"]))
    text = dict(rows)
    for members in groups.values():
        strings = {text[d][s:s + n] for d, s, n in members}
        assert len(strings) == 1 and len(members) > 1
        before = [text[d][s - 1] if s else None for d, s, _ in members]
        assert len(set(before)) > 1 or None in before or members[0][2] > repeats.LENGTH
    everywhere = [m for m in groups.values() if {d for d, _, _ in m} == {0, 1, 2, 7}]
    covered = {i for m in everywhere for d, s, n in m if d == 0 for i in range(s, s + n)}
    assert covered == set(range(3, 3 + len(same)))


def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality.classify(docs, labels).join(labels, "doc_id")
    n = {(r["quality"], r["accepted"]): r["count"] for r in out.groupBy("quality", "accepted").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.7 * (n[0, False] + n.get((0, True), 0))


def test_platt_is_monotone_and_calibrated():
    points = [(-2.0, 1, 5), (-2.0, 0, 95), (2.0, 1, 95), (2.0, 0, 5)]
    slope, offset = quality.platt(points)
    assert slope == pytest.approx(1.4, abs=0.1) and abs(offset) < 0.05
    assert quality.platt([(1.0, 1, 9)]) == (0.0, 0.0)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.learn_dictionaries(docs)
    assert set(model) == {"en", "fr", "de", "es"}
    out = language_id.identify(docs, model).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in out)
    assert right >= 0.97 * len(out) and all(0 <= r["score"] <= 1 for r in out)
    held = {r["doc_id"] for r in out}
    assert held == {i for (i,) in docs.select("doc_id").collect() if zlib.crc32(str(i).encode()) % 5 == 0}


def test_language_without_letters(make_docs):
    docs = make_docs([(1, "the cat sat on the mat and the dog", "en", "s"), (2, "le chat est sur la table et le chien", "fr", "s"),
                      (3, "123 $$", "en", "s"), (4, None, "en", "s")] * 2)
    got = {r["doc_id"]: r for r in language_id.identify(docs, {"en": b"the cat sat on the mat and the dog barked",
                                                                    "fr": b"le chat est sur la table et le chien aboie"}).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4)] == ["en", "fr", "und", "und"] and got[3]["score"] == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, {}).collect()} == {"und"}


def test_stages_judge_rows_of_one_id_each_by_its_text(spark, make_docs):
    """Rows that share an id, or have none, stay or go by their own text."""
    from lakelayer.llm.decontaminate import without_leaks
    from lakelayer.llm.exact_dedup import keep_first_copies
    from lakelayer.llm.near_dup import keep_one_per_component

    leak = " ".join(f"secret{i}" for i in range(30))
    clean = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(3)]
    bench = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    docs = make_docs([(5, leak), (5, clean[0]), (None, leak), (None, clean[1])])
    assert sorted(map(str, (r["text"] for r in without_leaks(docs, bench).collect()))) == sorted(clean[:2])
    copies = make_docs([(3, clean[0]), (5, clean[0] + " end"), (5, clean[1]), (None, clean[2])])
    assert sorted((str(r["doc_id"]), r["text"]) for r in keep_one_per_component(copies).collect()) == sorted(
        [("3", clean[0]), ("5", clean[1]), ("None", clean[2])])
    same = make_docs([(3, clean[0]), (5, clean[0]), (5, clean[1])])
    assert sorted((r["doc_id"], r["text"]) for r in keep_first_copies(same).collect()) == [(3, clean[0]), (5, clean[1])]
