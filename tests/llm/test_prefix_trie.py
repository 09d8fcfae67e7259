"""The prefix trie against sets of prefixes in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from os.path import commonprefix

from tessera.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def sequences(rows, shared):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        base, h = c - c % shared, zlib.crc32(str(c).encode()) % 4
        built[c] = turns if base == c else own.get(base, [])[:h] + turns[h:]
    return built


def brute(rows, shared=1):
    built = sequences(rows, shared)
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    out = []
    for node, convs in members.items():
        below = [v for v in members if v[: len(node)] == node]
        children = [v for v in below if len(v) == len(node) + 1]
        ended = sorted(c for c in convs if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children),
                    sum(not any(len(w) == len(v) + 1 and w[:-1] == v for w in below) for v in below),
                    sum((len(members[v]) - 1) * words(v[-1][1]) for v in below if v),
                    hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()))
    return sorted(out, key=str)


def made(df, **kw):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in pt.trie(df, **kw).select(*columns).collect()), key=str)


def conversations(rng, ids, longest, choices):
    texts = [f"t{i} " * (i % 4) for i in range(choices)] + [None, "", "é\x85 漢"]
    return [(c, t, rng.choice(["user", "user", None]), rng.choice(texts)) for c in ids for t in range(rng.randrange(1, longest))]


def test_two_fattest_is_divisible_by_the_highest_power():
    for low in range(40):
        for high in range(low + 1, 41):
            f = pt.two_fattest(low, high)
            best = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert low < f <= high and f & -f == best & -best


def test_locate_finds_the_exit_node_and_sums_reach_the_root():
    rng = random.Random(4)
    for _ in range(60):
        trie, seen = pt.ZFastTrie(), []
        for _ in range(rng.randrange(1, 60)):
            base = rng.choice(seen)[: rng.randrange(20)] if seen and rng.random() < 0.8 else ""
            text = base + "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
            path = [text[: i + 1].encode() for i in range(len(text))]
            longest = max((len(commonprefix([s, text])) for s in seen), default=0)
            at, common = trie.locate(path)
            assert common == longest and at.depth >= common
            assert common <= len(path) and (common == at.depth or at.parent.depth < common)
            end, _ = trie.insert(path, [1] * len(text))
            end.take(len(seen), 1, len(text))
            seen.append(text)
        rows = {r[0]: r for r in trie.expand(0, pt.ROOT, 0)}
        prefixes = {s[:i] for s in seen for i in range(len(s) + 1)}
        assert len(rows) == len(prefixes)
        for p in prefixes:
            r = rows[p.encode() or pt.ROOT]
            below = [i for i, s in enumerate(seen) if s.startswith(p)]
            assert r[2:] == (len(p), min(1, len(p)), max(0, len(p) - 1), below[0], len(below), sum(len(seen[i]) for i in below))


def test_trie_equals_sets_of_prefixes(spark):
    rng = random.Random(9)
    rows = conversations(rng, range(0, 70), 6, 2) + conversations(rng, [100, 119, 120, 121, 125, 400, 100_000, -3, -20, -25], 9, 1)
    rows += [(None, 0, "user", "lost"), (5, None, "user", "first"), (5, None, "user", "first"), (5, 2, "user", "a"), (5, 2, "user", "b")]
    rows += [(c, t, "user", "same text here") for c in range(200, 320) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'k' AS key", "1 AS digest", "2 AS words", "3 AS block", "4 AS a")
    for shared, segment, block in ((20, 4096, 200_000), (20, 2, 5), (1, 1, 1), (1, 3, 40)):
        assert made(df.repartition(7), shared=shared, segment=segment, block=block) == brute(rows, shared)


def test_turnless_long_and_empty(spark):
    # conversation 3 has fewer turns than it would take over, and its block has no first conversation
    lone = next(c for c in range(21, 40) if pt.heads(c) == 3)
    rows = [(lone, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert made(df, shared=20) == brute(rows, 20) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert made(df.limit(0)) == []
    rows = [(c, t, "user", "w " * (t % 3)) for c in (1, 2) for t in range(300)] + [(3, t, "user", "w " * (t % 3)) for t in range(150)]
    rows.append((4, 0, "user", "long " * 50_000))
    assert made(spark.createDataFrame(rows, SCHEMA), segment=64, block=100) == brute(rows)


def test_ids_of_a_hot_node_are_hashed_in_order(spark):
    ids = [*range(65_400, 65_700), 7, 200_000, -1, -70_000]
    rows = [(c, 0, "user", "hi") for c in ids]
    assert made(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)
