"""Prefix trie, spelling variants and benchmark passages against brute force, on odd rows too."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import contamination, prefix_trie, spelling

TURNS = "conv_id long, turn long, role string, text string, n_convs string, path string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# -- prefix trie -------------------------------------------------------------------------------


def plain_turns(rows):
    held = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            text = text or ""
            held[conv].append((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    return {conv: [(r, t) for _, _, r, _, t in sorted(turns)] for conv, turns in held.items()}


def rebuilt(convs):
    out = {}
    for conv, own in convs.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = convs.get(conv - conv % 20, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(node[:-1] for node in members if node)
    rows = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(WORDS.findall(n[-1][1])) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(own), len(node), parent, len(own), children[node], sum(not children[n] for n in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(rows)


def collected(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("seed, segment", [(0, 4096), (1, 2), (2, 3)])
def test_trie_against_brute_force(spark, seed, segment):
    draw = random.Random(seed)
    rows = []
    for conv in range(130):
        if draw.random() < 0.9:
            rows += [(conv, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "a b", "", None]), "x", "y") for turn in range(draw.randint(1, 9))]
    rows += [(conv, turn, "user", "the same", None, None) for conv in range(200, 260) for turn in range(5)]
    rows += [
        (41, None, "user", "first", "", ""), (41, 3, "user", "tie", "", ""), (41, 3, "user", "tie", "", ""), (41, 3, "assistant", "z", "", ""), (None, 1, "user", "lost", "", ""),
        (1043, 1, "user", "own", "", ""),  # alone and short, so it may be left without turns
    ]
    frame = spark.createDataFrame(rows, TURNS)
    convs = plain_turns(rows)
    assert collected(prefix_trie.shared_opening_trie(frame, segment=segment)) == plain_trie(rebuilt(convs))
    if seed == 1:
        assert collected(prefix_trie.conversation_trie(frame, segment=segment)) == plain_trie(convs)


def test_turnless_conversations_are_members_of_the_root(spark):
    conv = next(c for c in range(1, 500) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(conv, turn, "user", "x", "", "") for turn in range(2)]
    frame = spark.createDataFrame(rows, TURNS)
    assert collected(prefix_trie.shared_opening_trie(frame)) == plain_trie({conv: []})
    assert prefix_trie.shared_opening_trie(frame.limit(0)).collect() == []


def test_long_conversations_take_few_steps(spark):
    """Three thousand turns over three segments, two copies, and one that leaves them half way."""
    frame = spark.range(3000).selectExpr("explode(array(1L, 2L, 3L)) AS conv_id", "id AS turn", "'user' AS role", "id AS n")
    frame = frame.selectExpr("conv_id", "turn", "role", "concat('t', if(conv_id = 3 AND n >= 1500, -n, n)) AS text")
    rows = prefix_trie.conversation_trie(frame, segment=1024).collect()
    assert len(rows) == 1 + 1500 + 2 * 1500
    by = {(r["conv_id"], r["depth"]): r for r in rows}
    assert by[1, 0]["n_convs"] == 3 and by[1, 0]["n_leaves"] == 2 and by[1, 0]["saved_tokens"] == 1500 * 2 + 1500
    assert by[1, 1500]["n_children"] == 2 and by[3, 1501]["parent_conv_id"] == 1 and by[1, 2999]["saved_tokens"] == 2
    assert by[1, 3000]["ends_sha256"] == hashlib.sha256(b"1,2").hexdigest() and by[3, 3000]["n_convs"] == 1
    assert all(r["parent_conv_id"] == 1 for r in rows if 0 < r["depth"] <= 1500)


def test_ids_of_many_copies_are_digested_in_order(spark):
    frame = spark.range(0, 30_000, 3, 7).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'hello there' AS text")
    rows = {r["depth"]: r for r in prefix_trie.conversation_trie(frame).collect()}
    assert len(rows) == 2 and rows[1]["n_convs"] == 10_000 and rows[1]["saved_tokens"] == 2 * 9_999
    assert rows[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(0, 30_000, 3))).encode()).hexdigest()


# -- spelling variants -------------------------------------------------------------------------


def plain_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_forms(counts):
    form = {}
    near = {word: [other for other in counts if one_edit(word, other)] for word in counts}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, counts[word], len(near[word]), form[word], counts.get(form[word]), root))
    return rows


def test_spelling_against_brute_force(spark):
    draw = random.Random(5)
    stems = ["kingdom", "liberté", "straßen", "Üppigkeit", "aaaaaaa", "abababab", "mañanas", "÷×÷×÷×÷"]
    rows = [(None, "withoutid withoutid"), (1, None), (2, ""), (3, "letters" * 3000 + " " + "letters" * 3000)]
    for doc in range(400):
        words = []
        for _ in range(30):
            word = draw.choice(stems[: 1 + int(draw.expovariate(0.5)) % len(stems)])
            for _ in range(draw.choice([0, 0, 0, 0, 0, 1, 1, 2])):
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice("abé") + word[at:], word[:at] + draw.choice("xyK") + word[at + 1 :]])
            words.append(word)
        rows.append((10 + doc, draw.choice([" ", ", ", "1", "\n"]).join(words)))
    rows += rows[-5:]  # repeated rows count again
    frame = spark.createDataFrame([(*row, "w", 1) for row in rows], "doc_id long, text string, word string, n int")
    counts = plain_counts(rows)
    got = [tuple(row) for row in spelling.spelling_forms(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_forms(counts)
    assert any(row[5] != row[0] for row in got)
    assert spelling.spelling_forms(frame.limit(0)).collect() == []


def test_forms_are_followed_to_the_last(spark):
    words = {"chainaa": 2, "chainab": 20, "chainbb": 200, "chaicbb": 2000, "likeone": 30, "liketwo": 30}
    text = " ".join(" ".join([word] * n) for word, n in words.items())
    doc = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{word}".encode()) % 31 for word in words))
    rows = {r["word"]: r for r in spelling.spelling_forms(spark.createDataFrame([(doc, text)], "doc_id long, text string")).collect()}
    assert [rows[w]["form"] for w in words] == ["chainab", "chainbb", "chaicbb", None, None, None]
    assert {rows[w]["root"] for w in list(words)[:4]} == {"chaicbb"} and rows["likeone"]["root"] == "likeone"


@pytest.mark.parametrize("parts", [3, 4, 6])
def test_every_near_pair_shares_a_signature(spark, parts):
    """Any number of parts finds all pairs: the signatures only propose."""
    draw = random.Random(parts)
    words = sorted({"".join(draw.choice("ab") for _ in range(draw.randint(7, 9))) for _ in range(150)})
    frame = spark.createDataFrame([(word, 2) for word in words], "word string, n long")
    got = {tuple(sorted((r["a"], r["b"]))) for r in spelling.near_words(frame, parts).collect()}
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}


# -- benchmark passages ------------------------------------------------------------------------


def item_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[at : at + window])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    rows = []
    for key, text in docs:
        words, hit, found = item_words(text), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(words[at : at + n])]
        rows.append((key, len(words), frozenset(hit), tuple(sorted(found))))
    return Counter(rows)


def found_in(frame):
    return Counter(
        (r["doc_id"], r["n_words"], frozenset(i for s in r["spans"] for i in range(s["start"], s["end"])), tuple(r["items"])) for r in frame.collect()
    )


@pytest.mark.parametrize("seed", [0, 1])
def test_contamination_against_brute_force(spark, seed):
    draw = random.Random(seed)
    say = lambda n, k=40: " ".join(draw.choice(["ab", "Cd", "éf", "x1", "中文", "Ünd"]) + str(draw.randrange(k)) for _ in range(n))
    items = [(i, say(draw.choice([25, 12, 10, 9, 6, 4]))) for i in range(30)] + [(2, say(30)), (None, say(14)), (50, None), (51, ""), (52, "??"), (53, "Rare one")]
    items += [(60, items[0][1]), (61, items[0][1].upper()), (62, "aa " * 14), (9, "10 word")]
    docs = [(None, items[0][1]), (1, None), (2, ""), (2, ""), (3, "a, rare! one... and RARE (one)"), (4, "aa " * 30 + "aa, " * 9), (5, say(40_000, 3) + " " + items[1][1])]
    for i in range(120):
        text = items[draw.randrange(30)][1].split()
        a = draw.randrange(len(text))
        docs.append((10 + i, " ".join([say(draw.randrange(30)), " ".join(text[a:]), draw.choice([" ", "; "]).join(text[: a + 11]), say(5)])))
    docs += docs[-3:]
    frame = spark.createDataFrame([(*row, 1, "w") for row in docs], "doc_id long, text string, n_words int, row string").repartition(3)
    bench = spark.createDataFrame([(*row, 0) for row in items], "item_id long, text string, words int")
    assert found_in(contamination.contamination(frame, bench)) == plain_contamination(docs, items)
    assert found_in(contamination.contamination(frame, bench.limit(0))) == plain_contamination(docs, [])
    assert contamination.contamination(frame.limit(0), bench).collect() == []


def test_words_are_hashed_alike_in_any_blocks(monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choice("abC é中. \n9") for _ in range(draw.randrange(80))) for _ in range(60)] + ["x" * 500, "", "é" * 300]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    hasher = contamination._Hasher()
    whole = contamination._word_arrays(hasher, raw, offsets)
    words = [w for t in texts for w in item_words(t)]
    assert [bytes(raw[a:b]).decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(whole[0], whole[1], strict=True)] == words
    assert len(set(zip(words, whole[2].tolist(), strict=True))) == len(set(words)) == len(set(whole[2].tolist()))
    for size in (1, 7, 64):
        monkeypatch.setattr(contamination, "BLOCK_BYTES", size)
        assert all((a == b).all() for a, b in zip(contamination._word_arrays(hasher, raw, offsets), whole, strict=True))


def test_hits_are_found_by_words_not_by_the_map(spark, monkeypatch):
    """A map with every bit set lets all text through, and the result is the same."""
    monkeypatch.setattr(contamination, "_bitmap", lambda spark, windows: (np.full(1 << 6, -1, np.int64).view(np.uint64), 12))
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "a b")]
    docs = [(1, items[0][1]), (2, "x one two three four five six seven eight nine ten y a b"), (3, "none of it a, b? c"), (4, "b a")]
    got = contamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found_in(got) == plain_contamination(docs, items)
