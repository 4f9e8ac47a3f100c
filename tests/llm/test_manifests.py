"""License scan, prefix trie and Merkle manifest against brute force, and over odd rows."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wagewright.llm import conversation_trie, license_scan, merkle
from wagewright.llm.license_rules import WEIGHTS, rules_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_in(text):
    return WORDS.findall((text or "").translate(LOWER))


def scanned(text):
    """As the docstring of the scan says, without prefilter and sweep: every rule is tried at every word."""
    words = words_in(text)
    found = []
    for rule in rules_of():
        at = 0
        while at < len(words):
            hit = re.match(rule.expression, " " + "  ".join(words[at : at + 40]) + " ")
            n = len(hit[0].split()) if hit else 0
            if n:
                found.append((at, at + n, rule.priority, rule.order, rule.label, rule.base))
            at += n or 1
    kept = []
    for m in found:
        others = [o for o in found if o is not m and o[2] <= m[2] and o[0] <= m[0] and o[1] >= m[1]]
        if not any(o[1] - o[0] > m[1] - m[0] or o[2:4] < m[2:4] for o in others):
            kept.append(m)
    base = [m for m in found if m[5]]
    starts = [m[0] for m in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({m[4] for m in base})),
        ",".join(sorted({m[4] for m in base + kept})), max((WEIGHTS[m[2]] for m in kept), default=0.0),
    )


def test_license_scan_against_brute_force(spark):
    rng = random.Random(11)
    said = [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "All rights reserved.", "all RIGHTS reserved all rights reserved", "cc by cc-by, CC BY",
        "Released under the MIT License.", "mit Licence", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "Apache licence", "gpl-3 or bsd 2-clause",
        "SPDX-License-Identifier: Apache-2.0", "© 2024 Acme. Copyright 2019-2024 by Acme", "tous droits réservés", "general public licence", "XGeneral Public License", "ccby", "émit license", "a\x00cc\x7fby",
        "https://creativecommons.org/licenses/by-sa/4.0/", "neither the name of Acme nor the names of its contributors may be used to endorse or promote products", "Lesser General Public License v2.1", "unlicense", "placed into the public domain",
    ]
    texts = [None, "", " .,", *said] + [" ".join(rng.choice([rng.choice(said), "mit", "license", "the", "by", "cc", "Ärger", "general"]) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    texts += ["all rights reserved. " * 400 + "mit license", "w " * 3_000 + "cc by"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]
    frame = spark.createDataFrame([(i, t, 0.5, "x", ["k"]) for i, t in rows], "doc_id long, text string, score double, labels string, found array<string>")
    got = collections.Counter(tuple(r) for r in license_scan.scan(frame).collect())
    assert got == collections.Counter((i, *scanned(t)) for i, t in rows)
    assert license_scan.scan(frame.limit(0)).count() == 0


def test_license_spans(spark):
    frame = spark.createDataFrame([(1, "See: GNU General Public License version 3, all rights reserved")], "doc_id long, text string")
    row = license_scan.detected(frame).first()
    assert [(m["label"], m["first_word"], m["last_word"]) for m in row["kept"]] == [("gpl-3.0", 1, 6), ("reserved", 7, 9)]
    assert ("gpl", 2, 4) in [(m["label"], m["first_word"], m["last_word"]) for m in row["found"]]


def test_every_key_is_a_word_of_every_match():
    rules = rules_of()
    assert len(rules) > 250 and [r.order for r in rules] == list(range(len(rules)))
    for rule in rules:
        expression = rule.expression
        while (less := re.sub(r"\(\?:[^()]*\)\?", " ", expression)) != expression:
            expression = less
        needed = re.sub(r"\(\?:[^()]*\)", " ", expression).split()
        for keys in rule.keys:
            assert any(all(re.fullmatch(n, k) for k in keys) for n in needed if re.sub(r"\[[^\]]*\]|\w", "", n) == ""), rule


def trie_rows(rows, size=20):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, said), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / size) * size
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = collections.Counter(k[:-1] for k in nodes if k)
    out = collections.Counter()
    for k, members in nodes.items():
        below = [(q, m) for q, m in nodes.items() if q[: len(k)] == k]
        saved = sum((len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q, m in below if q)
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(k))))
        out[(min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], sum(not children[q] for q, _ in below), saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string, n long"


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATIONS)
    return collections.Counter(tuple(r) for r in conversation_trie.prefix_trie(frame).collect())


def test_prefix_trie_against_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    texts = ["a b", "a  b\tc", "", None, "é \x0b x", "long " * 4000]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in rng.sample(range(130), 60) + [-5, -25] for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", "same") for c in range(200, 280) for t in range(3)]  # copies in several families
    rows += [(7, None, "user", "x"), (7, 0, "user", "x"), (7, 0, "user", "x"), (7, 0, "tool", "y"), (None, 1, "user", "x"), (301, 0, "user", "no base"), (302, 0, None, None)]
    monkeypatch.setattr(conversation_trie, "PIECE", 20)
    assert trie(spark, rows) == trie_rows(rows)


def test_prefix_trie_of_little(spark):
    assert trie(spark, []) == collections.Counter()
    assert trie(spark, [(None, 1, "user", "x")]) == collections.Counter()
    # crc32("1") % 4 is 3: none of its own turns is left, and its base is absent.
    assert zlib.crc32(b"1") % 4 == 3
    none = hashlib.sha256(b"1").hexdigest()
    assert trie(spark, [(1, 0, "user", "x")]) == {(1, 0, None, 1, 0, 1, 0, none): 1}


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_rows(rows, tampered):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: hashed(*map(said, (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = ([leaf(r) for r in own], own)

    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([hashed(*levels[-1][j : j + 2]) for j in range(0, len(levels[-1]), 2)])
        return levels

    tops = up([up(trees[lang][0])[-1][0] for lang in langs])
    out = collections.Counter()
    for t, lang in enumerate(langs):
        levels = up(trees[lang][0])
        for i, r in enumerate(trees[lang][1]):
            node, path = leaf(r, 1) if tampered(r[0]) else leaf(r), []
            for place, tree in ((i, levels), (t, tops)):
                for nodes in tree[:-1]:
                    pair = nodes[place & ~1 : (place & ~1) + 2]
                    path += [x for j, x in enumerate(pair) if j != place & 1]
                    pair[place & 1] = node
                    node, place = hashed(*pair), place >> 1
            out[(r[0], leaf(r), levels[-1][0], tops[-1][0], hashed(*path), node, node == tops[-1][0])] += 1
    return out


@pytest.mark.parametrize(("levels", "task_nodes"), [(1, 7), (2, 1000), (4, 30)])
def test_manifest_against_brute_force(spark, levels, task_nodes):
    rng = random.Random(13)
    rows = [(i, f"text {i} é", rng.choice(["en", "en", "en", "de"]), rng.choice(["web", None]), rng.choice([5, None])) for i in range(90)]
    rows += [(i, "t", f"l{i % 9}", "s", i) for i in range(200, 214)] + [(500, "only", "zz", "s", 1), (501, None, None, None, None), (None, "x", "en", "s", 3), (None, None, None, "s", 2)]
    rows += [(3, "again", "en", "web", 1), (3, "again", "en", "web", 1), (600, "", "", "", 0), (601, "long " * 40_000, "ü", "s", (1 << 63) - 1)]
    tampered = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 0
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos long")
    got = merkle.manifest(frame, levels, task_nodes, tampered=merkle.every_seventh(F.col("doc_id")))
    want = manifest_rows(rows, tampered)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert {v[-1] for v in want} == {True, False}


def test_manifest_of_little(spark):
    frame = spark.createDataFrame([(1, "a", "en", None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.manifest(frame).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == hashed("")
    assert merkle.manifest(frame.limit(0)).collect() == []


def test_a_parent_waits_for_all_its_children():
    with pytest.raises(ValueError, match="has not heard"):
        merkle.completed(((0, 0), [(0, 4, 4, (b"",)), (2, 4, 4, (b"",))]), 2)
