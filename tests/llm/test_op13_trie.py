import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from adlake.llm import op13_trie

KIND = "conv_id long, turn long, role string, text string, depth string, name int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows, rebuild=True):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    if not rebuild:
        return convs
    out = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    return out


def brute(seqs):
    nodes = defaultdict(list)
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    children = defaultdict(list)
    for x in nodes:
        if x:
            children[x[:-1]].append(x)
    totals = {}
    for x in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[x]) - 1) * len(x[-1][1]) if x else 0
        below = [totals[y] for y in children[x]]
        totals[x] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    out = []
    for x, members in nodes.items():
        ends = sorted(c for c in members if len(seqs[c]) == len(x))
        out.append((min(members), len(x), min(nodes[x[:-1]]) if x else None, len(members), len(children[x]), *totals[x],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", 1) for r in rows], KIND)


def result(spark, rows, f=op13_trie.report):
    return sorted(map(tuple, f(frame(spark, rows)).select(*COLUMNS).collect()), key=str)


def conversations(seed, n=60, longest=9, words=2):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-150, 450), n):
        for t in range(rnd.randint(1, longest)):
            rows.append((c, t, rnd.choice(["user", None, ""]), rnd.choice(["", None, "aé😀", "b" * 5][: words + 1])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,longest", [(1, 9), (2, 40)])
def test_report_agrees_with_brute_force(spark, seed, longest):
    rows = conversations(seed, longest=longest)
    assert result(spark, rows) == brute(sequences(rows))


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(3, longest=5, words=1)
    assert result(spark, rows, op13_trie.conversation_trie) == brute(sequences(rows, rebuild=False))


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "lost"), (7, None, "user", "null turn is first"), (7, 0, None, None), (7, 5, "user", "x" * 70_000), (8, 3, "", "")]
    rows += [(100 + i, t, "user", "same") for i in range(30) for t in range(6)]  # equal conversations
    rows += [(9, 2, "user", "twice")] * 2 + [(-100, 1, "a", "b"), (-7, 1, "a", "b"), (-(2**62), 1, "a", "b")]
    assert result(spark, rows) == brute(sequences(rows))


def test_conversations_without_turns(spark):
    turnless = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 2)
    assert result(spark, [(turnless, 1, "user", "gone")]) == brute({turnless: []})
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "lost")]) == []


def test_one_very_long_conversation(spark):
    rows = [(3, t, "user", f"turn {t % 7}") for t in range(700)] + [(4, t, "user", f"turn {t % 7}") for t in range(650)] + [(5, 0, "user", "turn 0")]
    got = result(spark, rows, op13_trie.conversation_trie)
    assert got == brute(sequences(rows, rebuild=False))


def test_ids_of_one_end_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(op13_trie, "PIECE", 20)
    rows = [(c, 0, "user", "same") for c in range(1000, 1400)]
    assert result(spark, rows, op13_trie.conversation_trie) == brute(sequences(rows, rebuild=False))
