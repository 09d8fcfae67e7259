"""The text operators against brute force, libraries, round trips and edge cases."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from public_tokenizers import PATTERN, path

from tessera.llm import (byte_bpe, chat, chosen_path, decontaminate, packing, pu_quality, rules, substrings, suffix_tree,
                         warc)
from tessera.llm.common import WordHashes, shingles, words
from tessera.llm.components import components

VOCABULARY = path("byte_bpe_multi_50k.tiktoken")
EDGE = ["", None, " \n\t", "one", "a b c d", "été 漢字 🙂 ²½ \x85\xa0 x", "x" * 5000, "the " * 3000]


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, extra=False):
    rows = [(i, t, "en") for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.selectExpr("*", "doc_id AS key", "text AS sig", "lang AS words") if extra else df


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBPE.from_file_bytes(open(VOCABULARY, "rb").read())


def test_bpe_equals_the_tokenizer_library(bpe):
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    enc, rng = byte_bpe.TextEncoder(bpe), random.Random(1)
    parts = ["a", "b", " ", "\n", "é", "漢", "²", "Ⅷ", "\x1c", "\x85", "'s", "12", "🙂", "ing", "the", "ʰ", "aaaa" * 9]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)] + [t or "" for t in EDGE]
    for text in texts + ["a" * 3000, "ab" * 2000, "theing" * 900]:
        ids = np.frombuffer(enc.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_bpe_join_is_the_encoding_of_both(bpe):
    rng = random.Random(2)
    for _ in range(500):
        a, b = (bytes(rng.choice(b"thedingaso ") for _ in range(rng.randrange(60))) for _ in range(2))
        assert bpe.join(bpe.reduce(a), bpe.reduce(b)) == bpe._merge_long(a + b) if a + b else True


def test_bpe_on_a_table(spark):
    df = documents(spark, list(enumerate(EDGE)), extra=True)
    out = byte_bpe.decode(byte_bpe.encode(df, VOCABULARY), VOCABULARY).collect()
    assert [bytes(r["decoded"]) for r in out] == [(t or "").encode() for t in EDGE]
    assert byte_bpe.encode(df.limit(0), VOCABULARY).count() == 0


def test_chat_round_trip_and_mask(spark):
    tricky = [r"\### Assistant: </turn> ok", r"\</turn>", r"\\<turn><text>", "", None, "<tu<turn>rn>"]
    rows = [(c, t, ("user", "assistant", None, "<turn>")[t % 4], text) for c, text in enumerate(tricky) for t in range(6)]
    rows += [(None, 0, "assistant", "x"), (0, 0, "user", tricky[0])]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_turns(chat.format_turns(turns, VOCABULARY), VOCABULARY)
    assert Counter((r.conv_id, r.turn, r.role, r.text) for r in back.collect()) == Counter(
        (c, t, r or "", x or "") for c, t, r, x in rows)
    got = {r.conv_id: r for r in chat.digests(back).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(own), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(back.limit(0)).count() == 0


def test_rules_against_python(spark):
    rng = random.Random(3)
    texts = EDGE + [prose(rng, rng.randrange(1, 200), 12) for _ in range(60)] + ["a b c\na b c\n\n a b c"]
    got = {r.doc_id: r for r in rules.judge(documents(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        own = [w.decode() for w in (text or "").encode().split()]
        seen = Counter(zip(own, own[1:], own[2:]))
        covered = {i + d for i in range(len(own) - 2) for d in range(3) if seen[tuple(own[i : i + 3])] > 1}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(own), sum(map(len, own)), len(covered)), repr(text)[:80]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(own) < 50 or 100 * len(covered) > 50 * len(own)) and not (r.kept and r.base_failed)


def test_myers_and_pigeonhole_against_brute_force():
    rng = random.Random(4)

    def best(pattern, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(pattern, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    for _ in range(800):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(20, 40)))
        text = list("".join(rng.choice("abc ") for _ in range(30)) + item + "cab")
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = rng.choice(["", "a", "bb", "c"])
        item, text = decontaminate.normal(item), decontaminate.normal("".join(text))
        k = int(len(item) * 0.1)
        got = decontaminate.Matcher([(1, item)], 0.1).search(text)
        least = best(item, text)
        assert (got[0][1] if got else None) == (least if least <= k else None)
    assert decontaminate.Matcher([(1, ""), (2, None)], 0.1).search("abc") == []


def test_decontaminate_tables(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away from the bear"
    docs = documents(spark, [(1, "x " + item + " y"), (2, "clean"), (3, None), (1, "x " + item), (None, item.upper())], extra=True)
    items = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()) == Counter(
        [(1, 7), (1, 7), (None, 7)])
    assert [r.doc_id for r in decontaminate.clean(docs, items, block_chars=50).collect()] == [2, 3]
    assert decontaminate.clean(docs, items.limit(0)).count() == 5 and decontaminate.matches(docs.limit(0), items).count() == 0


def brute_links(texts, threshold=0.8):
    hashes = WordHashes()
    sets = {i: frozenset(shingles(hashes.array(t)).tolist()) for i, t in texts}
    links, root = Counter(), {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def test_chosen_path_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BUCKET", 12)  # so that buckets are split, and at last tiled
    monkeypatch.setattr(chosen_path, "LARGE", 2)
    rng = random.Random(5)
    line = prose(rng, 12)
    base = [prose(rng, 90, 3000) for _ in range(12)]
    texts = []
    for i in range(220):
        own = base[i % 12 if i < 110 else 0].split()
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(9)}"
        texts.append((i, line + " " + " ".join(own) if i % 3 else prose(rng, 40, 5000) + " " + line))
    texts += [(500 + i, t) for i, t in enumerate(EDGE)] + [(600, texts[1][1]), (601, "one"), (602, "a b c d")]
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.join(documents(spark, texts, extra=True), recall=0.9999).collect()}
    assert got == brute_links(texts)


def test_chosen_path_deals_dense_groups_in_tiles_and_splits_others(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BUCKET", 24)
    monkeypatch.setattr(chosen_path, "LARGE", 1)
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    base, texts = word(140), []
    for i in range(120):  # near copies, each with words of its own in places of its own
        text = list(base)
        for at in rng.integers(0, 140, rng.integers(0, 5)):
            text[at] = word(1)[0]
        texts.append((i, " ".join(text)))
    passage = word(30)
    texts += [(i, " ".join(word(40) + passage)) for i in range(200, 500)]  # a frequent passage in texts that differ otherwise
    docs = documents(spark, texts)
    reps = chosen_path.describe(docs, 12, 0.8).withColumnRenamed("doc_id", "rep").dropDuplicates(["sig"]).cache()
    dealt = chosen_path.buckets(docs, reps, 0.8, [12, 15, 15, 16, 17, 18]).join(reps.select("sig", "rep"), "sig").collect()
    parts = {r.path for r in dealt if r.part}
    assert parts & set().union(*(r.paths for r in reps.where("rep < 200").collect())), "the dense group is dealt in parts at once"
    first = set().union(*(r.paths for r in reps.where("rep >= 200").collect()))
    assert not parts & first, "the frequent passage is split first"
    assert max(Counter((r.tile, r.path) for r in dealt).values()) <= 2 * 24, "tiles are bounded"
    links = brute_links(texts)
    assert sum(n for _, n in links.values()) > 2000
    assert {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.join(docs, recall=0.9999).collect()} == links


def test_chosen_path_runs_reach_the_recall_for_subset_pairs():
    rng = np.random.default_rng(10)

    def met(runs, depth, pairs=400):
        """Share of pairs, one set inside the other at Jaccard 0.8, that stay together ``depth`` times in a run."""
        found = 0
        for _ in range(pairs):
            whole = rng.integers(0, 2**63, 100).astype(np.uint64)
            for r in range(runs):
                paths = [chosen_path.seeded(r)]
                for _ in range(depth):
                    paths = [x for p in paths for x in np.intersect1d(chosen_path.picked(whole, p, 0.8), chosen_path.picked(whole[:80], p, 0.8))]
                if paths:
                    found += 1
                    break
        return found / pairs

    runs = chosen_path.runs_of(0.99)
    assert all(met(n, depth) >= 0.985 for depth, n in enumerate(runs, 1)) and len(runs) == chosen_path.DEPTH  # 0.99, less what 400 pairs scatter
    assert met(8, chosen_path.DEPTH) < 0.93  # as many as there were


def test_chosen_path_gathers_no_sets_by_a_frequent_passage(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BUCKET", 24)
    monkeypatch.setattr(chosen_path, "LARGE", 1)
    written = Counter()

    def counted(df, name, write=chosen_path.staged):
        out = write(df, name)
        written[name] += out.count()
        return out

    monkeypatch.setattr(chosen_path, "staged", counted)
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    passage, texts = word(40), []
    for i in range(400):
        own = word(70) if i % 2 == 0 else own[:66] + word(4)
        texts.append((i, " ".join(own + passage)))
    links = brute_links(texts)
    assert sum(n for _, n in links.values()) == 400
    assert {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.join(documents(spark, texts), recall=0.9999).collect()} == links
    assert written["join-split"] == 0, "nothing is left to split"


def test_chosen_path_pairs_meet_as_often_whatever_is_frequent():
    rng = np.random.default_rng(11)
    roots = [chosen_path.seeded(r) for r in range(4000)]
    # shingles that both have, only the first, only the second (similarity 0.8), and how many of each are frequent
    for both, one, other, hot in ((80, 20, 0, (50, 0, 0)), (80, 20, 0, (60, 20, 0)), (80, 0, 20, (60, 0, 20)), (80, 10, 10, (68, 10, 0)),
                                  (80, 10, 10, (62, 0, 10)), (80, 20, 0, (80, 20, 0)), (80, 20, 0, (72, 0, 0)), (80, 10, 10, (65, 5, 5))):
        parts = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (both, one, other)]
        frequent = np.sort(np.concatenate([p[:n] for p, n in zip(parts, hot)]))
        x, y = np.concatenate([parts[0], parts[1]]), np.concatenate([parts[0], parts[2]])
        limits = [chosen_path.limits(s, 0.8, frequent) for s in (x, y)]
        common = [len(np.intersect1d(*(chosen_path.picked(s, r, 0.8, n) for s, n in zip((x, y), limits)))) for r in roots]
        assert np.mean(common) >= 0.94, (both, one, other, hot)  # 1, less what 4,000 runs scatter
        if hot[0] == 50:
            assert not any(len(np.intersect1d(chosen_path.picked(x, r, 0.8, limits[0]), chosen_path.picked(frequent, r, 0.01))) for r in roots[:50])


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(30)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 131)}}


def test_passages_find_planted_repeats_and_leave_the_rest(spark):
    rng = random.Random(6)
    shared, short = prose(rng, 60, 9000), prose(rng, 30, 9000)
    texts = [(i, prose(rng, 120, 9000)) for i in range(40)]
    for i in (3, 9, 20, 31):
        texts[i] = (i, f"{prose(rng, 20 + i, 9000)} {shared} {prose(rng, 50, 9000)}")
    for i in (5, 6):
        texts[i] = (i, f"{prose(rng, 60, 9000)} {short} {prose(rng, 60, 9000)}")
    docs = documents(spark, texts + [(90 + i, t) for i, t in enumerate(EDGE)] + [(None, texts[3][1])], extra=True)
    found = substrings.passages(docs)
    got = {(r.doc_id, r.start_word, r.end_word) for r in found.collect()}
    assert got == {(i, 20 + i, 80 + i) for i in (9, 20, 31)}
    cut = {r.doc_id: r.text for r in substrings.cut(docs, found).collect() if r.doc_id is not None}
    for i, text in texts:
        assert cut[i] == (text if i not in (9, 20, 31) else text.replace(shared + " ", ""))


def test_passages_with_an_inserted_deleted_or_replaced_word(spark):
    rng = random.Random(11)
    texts, wanted = [], {}
    for edit, length in itertools.product(("insert", "delete", "replace"), (55, 60, 70)):
        for _ in range(30):
            own = prose(rng, length, 10**6).split()
            at, i = length // 2, 2 * len(wanted)
            other = own[:at] + {"insert": ["new"] + own[at : at + 1], "delete": [], "replace": ["new"]}[edit] + own[at + 1 :]
            texts += [(i, f"{prose(rng, 60, 10**6)} {' '.join(other)} {prose(rng, 60, 10**6)}"),
                      (i + 1, f"{prose(rng, 60, 10**6)} {' '.join(own)} {prose(rng, 60, 10**6)}")]
            wanted[i + 1] = edit, length
    met = {r.doc_id for r in substrings.passages(documents(spark, texts)).collect() if r.ref_doc_id == r.doc_id - 1}
    found = Counter(wanted[i] for i in met)
    assert all(found[kind] >= 29 for kind in wanted.values()), found


def test_whole_passages_are_found_among_parts_of_them(spark):
    """A passage in one early and one late document, with documents that hold 47 of its words before and between."""
    rng = random.Random(13)
    texts, wanted, n = {}, [], 0

    def add(inside):
        nonlocal n
        texts[n] = f"{prose(rng, 40, 10**6)} {' '.join(inside)} {prose(rng, 40, 10**6)}"
        n += 1

    for before, between in ((0, 80), (30, 30), (59, 0), (60, 20)):
        for _ in range(3):
            own = prose(rng, 60, 10**6).split()
            for many in (before, between):
                for _ in range(many):
                    size = rng.choice((47, 48, 49))
                    start = rng.randrange(60 - size + 1)
                    add(own[start : start + size])
                add(own)
            wanted.append((n - 1, n - 2 - between))
    got = {(r.doc_id, r.ref_doc_id): (r.start_word, r.end_word) for r in substrings.passages(documents(spark, texts.items())).collect()}
    assert got == dict.fromkeys(wanted, (40, 100))


def test_copies_are_passages_as_a_whole_and_repeated_ids_are_not(spark):
    rng = random.Random(14)
    long, short = prose(rng, 80, 10**6), prose(rng, 49, 10**6)
    texts = [(4, long), (2, long), (2, long), (9, long), (7, short), (8, short), (2, prose(rng, 80, 10**6)), (None, long), (11, f"a {long} b")]
    got = {tuple(r)[:4] for r in substrings.passages(documents(spark, texts)).collect()}
    assert got == {(4, 0, 80, 2), (9, 0, 80, 2), (11, 1, 81, 2)}
    assert substrings.passages(documents(spark, texts).limit(0)).count() == 0


def test_run_hashes_and_open_runs():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 9, 60).astype("<u4")
    tokens[40:50] = tokens[10:20]
    hashes = substrings.run_hashes(tokens, 6)
    for i in range(55):
        for j in range(55):
            assert (hashes[i] == hashes[j]) == (tokens[i : i + 6] == tokens[j : j + 6]).all()
    assert substrings.open_runs([(0, 4), (0, 30)], [(26, 34)], 33, 6, functions=1).tolist() == [0, 1, 2, 3, 4, 25]
    assert substrings.open_runs([(0, 4), (1, 8), (1, 30)], [], 33, 6, functions=2).tolist() == [3, 4]
    assert substrings.open_runs([(0, 2)], [], 5, 6, functions=1).tolist() == []


def test_compact_windows_cover_every_long_run():
    rng = np.random.default_rng(7)
    tokens, least = rng.integers(0, 2**63, 200).astype(np.uint64), 15
    starts, sizes = np.array([0, 120]), np.array([120, 80])
    c, left, right, owner = substrings.compact_windows(tokens, starts, sizes, 0, least)
    for t in range(2):
        for a in range(starts[t], starts[t] + sizes[t] - least + 1):
            for b in range(a + least - 1, starts[t] + sizes[t]):
                covering = [i for i in range(len(c)) if left[i] <= a <= c[i] <= b <= right[i]]
                assert len(covering) == 1 and owner[covering[0]] == t


def test_suffix_tree_base_and_distribution(spark):
    rng = random.Random(8)
    texts = [(i, ("Alpha beta gamma " * 5 if i % 2 else "") + prose(rng, 60, 30)) for i in range(120)] + [(900 + i, t) for i, t in enumerate(EDGE)]
    got = {r.doc_id: r for r in suffix_tree.score(documents(spark, texts, extra=True)).collect()}
    end, count = b"", Counter()
    for i, t in texts:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update([*words(t), end])
    n, v = sum(count.values()), len(count)
    gain = 0.0
    for i, t in texts:
        own = [*words(t), end]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        r = got[i]
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        gain += r.score - r.base_score if r.held_out else 0
    assert gain > 0  # contexts help on texts that were not learned from
    assert suffix_tree.score(documents(spark, texts).limit(0)).count() == 0


def test_suffix_tree_keeps_rare_contexts_in_a_larger_corpus(spark):
    rng = random.Random(9)
    trained = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = next(i for i in range(400) if i not in trained)
    texts = {i: prose(rng, 800, 20000) for i in range(400)}
    for i in trained[:3]:
        texts[i] += " rare word"
    texts[held] = "rare word"  # seen 3 times in 250,000 tokens
    got = {r.doc_id: r for r in suffix_tree.score(documents(spark, texts.items())).collect()}
    assert got[held].score - got[held].base_score > 2


def brute_tree(texts, gain, mu, order=None):
    """(probability function, contexts) of a suffix tree kept in dictionaries."""
    train = [[*words(t), b""] for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(tuple(t[a:b]) for t in train for a in range(len(t)) for b in range(a + 1, min(len(t), a + 9) + 1))
    n, v = sum(map(len, train)), len({w for t in train for w in t})
    states = {}

    def probability(context, word):
        p = (counts[(word,)] + 0.5) / (n + 0.5 * (v + 1))
        for k in range(1, len(context) + 1):
            own = context[len(context) - k :]
            if own not in states:
                break
            kept = states[own]
            p = (kept.get(word, 0) + (mu + counts[own] - sum(kept.values())) * p) / (counts[own] + mu)
        return p

    for k in range(1, 9):
        level = {}
        for context in {r[:-1] for r in counts if len(r) == k + 1}:
            if counts[context] < 2 or k > 1 and context[1:] not in states:
                continue
            kept = {}
            for run in (r for r in counts if len(r) == k + 1 and r[:-1] == context):
                p, total, seen = probability(context, run[-1]), counts[context], counts[run]
                if seen >= 2 and counts[run[1:]] >= 2 and seen > total * p and seen * math.log(seen / (total * p)) > gain:
                    kept[run[-1]] = seen
            if kept:
                total, taken = counts[context], sum(kept.values())
                expected = sum(probability(context, w) for w in kept)
                rest = max(total - taken, 0.5)
                gained = sum(c * math.log(c / (total * probability(context, w))) for w, c in kept.items())
                if gained + rest * math.log(rest / total / max(1 - expected, 1e-12)) > gain * len(kept):
                    level[context] = kept
        if not level or order is not None and k > order:
            break
        states |= level
    return probability, states, {w for t in train for w in t}


@pytest.mark.parametrize("order", [None, 1])
def test_suffix_tree_scores_equal_a_tree_in_dictionaries(spark, order):
    rng = random.Random(12)
    line = "the cat sat on the mat and the dog sat on the cat near a red door".split()
    texts = [(i, " ".join(line[a:] + line[:a]) + " " + prose(rng, 12, 9)) for i in range(40) for a in [rng.randrange(12)]]
    texts += [(100 + i, prose(rng, 30, 9)) for i in range(20)] + [(200 + i, t) for i, t in enumerate(EDGE[:5])] + [(3, "the cat")]
    probability, states, vocabulary = brute_tree(texts, 6.0, 20.0, order)
    assert (max(map(len, states)) >= 3) if order is None else (max(map(len, states)) == 1)
    got = Counter()
    for r in suffix_tree.score(documents(spark, texts).repartition(3), block_bytes=500, order=order).collect():
        got[r.doc_id, round(r.score, 6)] += 1
    wanted = Counter()
    for i, t in texts:
        own = (*words(t), b"")
        wanted[i, round(sum(math.log10(probability(own[:j], own[j])) for j in range(len(own))), 6)] += 1
    assert got == wanted
    for context in list(states)[:20]:  # all words and one that no training text has
        assert sum(probability(context, w) for w in [*vocabulary, b"?"]) == pytest.approx(1)


def test_suffix_tree_sends_runs_and_contexts_packed(spark, monkeypatch):
    written = Counter()

    def counted(df, name, write=suffix_tree.staged):
        out = write(df, name)
        written[name] += out.count()
        return out

    monkeypatch.setattr(suffix_tree, "staged", counted)
    monkeypatch.setattr(suffix_tree, "RANGE", 1500)  # several ranges of keys
    rng = random.Random(12)
    texts = [(i, prose(rng, 60, 40)) for i in range(60)]
    got = {r.doc_id: r.score for r in suffix_tree.score(documents(spark, texts).repartition(2), block_bytes=4000).collect()}
    n_blocks = -(-sum(len(t) for _, t in texts) // 4000) + 2
    assert written["lm-found"] <= 5 * 5 * n_blocks, "rows per block, level and range, not per word, run or context"
    monkeypatch.setattr(suffix_tree, "RANGE", 10**6)
    other = {r.doc_id: r.score for r in suffix_tree.score(documents(spark, texts).repartition(5), block_bytes=900).collect()}
    assert got.keys() == other.keys() and all(abs(got[i] - other[i]) < 1e-9 for i in got), "the same however it is dealt"


def test_suffix_tree_counts_contexts_whose_first_words_are_no_states(spark):
    # only "z" tells what follows, and what stands before it, up to four words back
    rng = random.Random(5)

    def text():
        own = []
        while len(own) < 120:
            own += [*(rng.choice("abc") for _ in range(rng.randrange(3, 6))), "z"]
            back = rng.choice([1, 2, 3, 4, 4, 4])
            own.append(f"s{zlib.crc32(' '.join(own[-back:]).encode()) % 40}")
        return " ".join(own)

    texts = [(i, text()) for i in range(50)]
    probability, states, _ = brute_tree(texts, 6.0, 20.0)
    assert max(map(len, states)) >= 4 and ("a",) not in states
    got = {r.doc_id: r.score for r in suffix_tree.score(documents(spark, texts).repartition(2), block_bytes=9000).collect()}
    for i, t in texts:
        own = (*words(t), b"")
        assert got[i] == pytest.approx(sum(math.log10(probability(own[:j], own[j])) for j in range(len(own))), abs=1e-6)


def test_suffix_tree_numbers_words_as_they_are_split():
    rng = random.Random(6)
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(" aB\n\t\x0b\x1cé Z\x00") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 8))]
        vocabulary, found, sizes = suffix_tree.numbered(pa.array(["x y", *texts, "q"], pa.string()).slice(1, len(texts)))
        assert [vocabulary[i] for i in found] == [w for t in texts for w in words(t)] and sizes.tolist() == [len(words(t)) for t in texts]


def test_suffix_tree_without_training_rows(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1][:4]
    for r in suffix_tree.score(documents(spark, [(i, "a b a b") for i in held])).collect():
        assert (r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) == (0, 0, 0.0, 0.0, True)


def test_pu_classifier_separates_held_out_rows(spark):
    rng = random.Random(9)
    good = [f"{prose(rng, rng.randrange(30, 200))}." for _ in range(300)]
    bad = [" ".join(w + "$$$" for w in prose(rng, rng.randrange(30, 200)).split()) for _ in range(100)]
    texts = list(enumerate(good + bad + EDGE))
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(400) if i % 3], "doc_id long, quality int")
    out = pu_quality.classify(documents(spark, texts, extra=True), labels).toPandas().set_index("doc_id")
    assert len(out) == len(texts) and out.score.between(0, 1).all()
    held = out[out.held_out & (out.index < 400)]
    assert ((held.index < 300) == (held.predicted == 1)).mean() > 0.9
    named = documents(spark, texts).selectExpr("*", "1 AS score", "'m' AS measures", "2 AS held_out", "'x' AS predicted")
    kept = pu_quality.classify(named, labels, keep=named.columns)
    assert kept.columns == ["doc_id", "text", "lang", "measures", "held_out", "score", "predicted"]
    assert {r.doc_id: r.score for r in kept.collect()} == out.score.to_dict()
    assert pu_quality.classify(named.limit(0), labels).count() == 0
    assert len(pu_quality._sample(pu_quality.measured(spark.range(5000).selectExpr("id AS doc_id", "'a b' AS text"), ["doc_id"]), 100)) == 100
    none = pu_quality.classify(documents(spark, texts), labels.limit(0)).toPandas()
    assert (none.score == 0.5).all()
    assert pu_quality.estimate_prior(np.linspace(0, 1, 4000), np.r_[np.linspace(0, 1, 3000), np.zeros(1000) - 1]) == pytest.approx(0.75, abs=0.05)


def test_packing_is_lossless_and_best_fit(spark):
    rng = np.random.default_rng(10)
    lengths = rng.integers(1, 100, 300)
    bins = packing.best_fit_decreasing(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(lengths[b].sum() <= 100 for b in bins)
    open_bins = []  # plain best fit decreasing
    for i in np.argsort(-lengths, kind="stable"):
        fits = [b for b in open_bins if b[0] >= lengths[i]]
        b = min(fits, key=lambda x: x[0]) if fits else [100]
        if not fits:
            open_bins.append(b)
        b[0] -= lengths[i]
    assert len(bins) == len(open_bins)
    docs = [(1, rng.integers(0, 50000, 5000).astype("<u4")), (None, np.zeros(0, "<u4")), (3, rng.integers(0, 50000, 70).astype("<u4"))]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in docs] + [(4, None)], "doc_id long, ids binary")
    packed = packing.pack(df.coalesce(1), length=512)
    parts, rows = {}, packed.collect()
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == 512
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            assert (places[a:b] == np.arange(b - a)).all()
            parts.setdefault(doc, {})[start] = ids[a:b]
    for i, x in [*docs, (4, np.zeros(0, "<u4"))]:
        assert np.concatenate([parts[i][s] for s in sorted(parts[i])]).tolist() == [*x.tolist(), 50256]
    assert packing.segments(packed).where("NOT resets").count() == 0 and packing.pack(df.limit(0)).count() == 0


def test_texts_are_packed_as_the_library_encodes_them(spark):
    rng = random.Random(15)
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=byte_bpe.ByteBPE.from_file_bytes(open(VOCABULARY, "rb").read()).ranks,
                                special_tokens={})
    texts = [(i, prose(rng, rng.randrange(1, 400))) for i in range(60)] + [(100 + i, t) for i, t in enumerate(EDGE)] + [(None, "a"), (3, "again")]
    packed = packing.pack_texts(documents(spark, texts, extra=True).withColumn("ids", F.lit(1)).repartition(2), VOCABULARY, length=256).collect()
    parts = {}
    for r in packed:
        ids = np.frombuffer(r.ids, "<u2")
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            parts.setdefault((doc, start), []).append(ids[a:b].tolist())
    wanted = {}
    for i, t in texts:
        own = [*library.encode_ordinary(t or ""), 50256]
        for start in range(0, len(own), 256):
            wanted.setdefault((i, start), []).append(own[start : start + 256])
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in wanted.items()}
    filled = sum(len(v) for vs in parts.values() for v in vs) / (256 * len(packed))
    assert filled > 0.97 and packing.pack_texts(documents(spark, texts).limit(0), VOCABULARY).count() == 0


def test_packing_refuses_ids_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, bytearray(np.array([5, 70_000], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="70000 of document 1 does not fit"):
        packing.pack(df).collect()
    row = packing.pack(df, dtype="<u4").first()
    assert np.frombuffer(row.ids, "<u4")[:3].tolist() == [5, 70_000, 50256]


def test_warc_records_are_valid_and_have_ids_of_their_own(spark, tmp_path):
    import zstandard

    rows = [(1, "http://x/1", "<p>a</p>"), (1, "http://x/1", "<p>a</p>"), (2, "http://x/2", "<p>a</p>"), (3, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS digest", "1 AS first", "2 AS n")
    folder = str(tmp_path / "warc")
    warc.write_bundles(pages.coalesce(1), folder, date="2024-01-01T00:00:00Z").write.parquet(str(tmp_path / "manifest"))
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    named = manifest.collect()
    assert len({r.record_id for r in named}) == 4
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(open(f"{folder}/{n}", "rb"), read_across_frames=True).read()
                     for n in {r.bundle for r in named})
    records = whole.split(b"WARC/1.1\r\n")[1:]
    assert records[0].startswith(b"WARC-Type: warcinfo") and len(records) == 5
    for record in records:
        head, _, rest = record.partition(b"\r\n\r\n")
        field = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Type"} <= field.keys()
        assert rest[int(field["Content-Length"]) :] == b"\r\n\r\n"
        if field["WARC-Type"] != "warcinfo":
            assert rest.startswith(b"HTTP/1.1 200 OK\r\n") and field["WARC-Record-ID"][1:-1] in {r.record_id for r in named}
    back = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_records(manifest, folder).collect())
    assert back == [(1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "response", None)]
    assert warc.write_bundles(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", "", None, "é" * 4000, "\r\n\r\nWARC/1.1", "<p>a</p>"]
    rows = [(10 - i, f"http://x/{i}\r\n", h) for i, h in enumerate(html)] + [(None, None, "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = str(tmp_path / "warc")
    manifest = warc.write_bundles(pages, folder, frame_bytes=600, bundle_bytes=900)
    manifest.write.parquet(str(tmp_path / "manifest"))
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    got = {r.page_id: r for r in warc.read_records(manifest, folder).collect()}
    assert len(got) == len(rows)
    for page, url, text in rows:
        same = [p for p, _, h in rows if (h or "") == (text or "") and p is not None]
        r = got[page]
        payload = (text or "").encode()
        assert r.payload_bytes == len(payload) and r.url == (url or "")
        if page == min(same):
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, payload)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", min(same), None)


def test_chosen_path_near_copies_meet_where_few_shingles_are_picked():
    rng = np.random.default_rng(13)
    met = []
    for _ in range(4000):
        base = rng.integers(0, 2**63, 146).astype(np.uint64)
        six = np.concatenate([chosen_path.picked(base, chosen_path.seeded(r), 0.8) for r in range(6)])
        if len(six) > 2:
            continue
        copies = [np.concatenate([rng.permutation(base)[8:], rng.integers(0, 2**63, 8).astype(np.uint64)]) for _ in range(20)]
        paths = [set(chosen_path.first_paths(c, 6, 0.8, chosen_path.limits(c, 0.8)).tolist()) for c in copies]
        met += [bool(a & b) for a, b in itertools.combinations(paths, 2)]
    assert len(met) > 2000 and np.mean(met) >= 0.99
