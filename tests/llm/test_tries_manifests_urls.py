"""Prefix trie, Merkle manifest and URL filters against plain Python statements of the same rules."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import merkle, prefix_trie, url_filters
from sluice.llm.scratch import Scratch

TURNS = "conv_id long, turn long, role string, text string, depth string, n long, shard string, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], TURNS)


def ordered(rows):
    found = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found.setdefault(c, []).append((t is not None, t, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    return {c: [x[3:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, v in found.items()}


def plain_trie(sequences):
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = set()
    for key, ids in members.items():
        below = [k for k in members if k[:len(key)] == key]
        inner = {k[:-1] for k in members if k}
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in ids if len(sequences[c]) == len(key))))
        out.add((min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids), sum(len(k) == len(key) + 1 for k in below),
                 sum(k not in inner for k in below), saved, sha(ends)))
    return out


def as_set(df):
    rows = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def chatter(draw, n, longest=9):
    rows = [(None, 0, "user", "lost"), (7, None, None, None), (7, None, None, None), (7, 3, "user", "é" * 40_000), (7, 3, "user", "tie"), (-120, 0, "user", "a")]
    for c in list(range(n)) + [-3, 100, 200, 205]:
        for t in draw.sample(range(40), draw.randrange(1, longest)):
            rows.append((c, t - 20, draw.choice(["user", "bot", None]), draw.choice(["a", "b", "", None])))
    return rows


@pytest.mark.parametrize("limit,chunk", [(4096, 4096), (3, 2), (20, 5)])
def test_trie(spark, monkeypatch, limit, chunk):
    """Small limits move most nodes to the trunk; small chunks cut conversations and lists of ids."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie.math, "isqrt", lambda n: 0)
    rows = chatter(random.Random(11), 60)
    assert as_set(prefix_trie.conversation_trie(turns(spark, rows), limit)) == plain_trie(ordered(rows))


def test_trie_of_rebuilt_conversations(spark):
    import zlib
    rows = [(100, t, "user", f"t{t}") for t in range(3)] + chatter(random.Random(12), 30)
    own = ordered(rows)
    rebuilt = {}
    for c, s in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        rebuilt[c] = own.get(base, [])[:h] + s[h:]
    assert any(not s for s in rebuilt.values())  # conversations without turns stay members of the root
    found = prefix_trie.grafted(turns(spark, rows), Scratch(spark, "test"))
    assert as_set(prefix_trie.trie(*found)) == plain_trie(rebuilt)


def test_trie_hot_and_empty(spark):
    same = [(c, t, "user", "same") for c in range(700) for t in range(2)] + [(900, t, "user", f"long {t}") for t in range(3000)]
    rows = as_set(prefix_trie.conversation_trie(turns(spark, same), 64))
    assert (0, 2, 0, 700, 0, 1, 699 * 4, sha(",".join(map(str, range(700))))) in rows and len(rows) == 3003
    assert (0, 0, None, 701, 2, 2, 699 * 8, sha("")) in rows
    assert prefix_trie.conversation_trie(turns(spark, [])).isEmpty()


def test_trie_hashes_again_after_a_clash(spark, monkeypatch):
    true = prefix_trie.prefixes

    def clashing(found, scratch, seed=0):
        out = true(found, scratch, seed)
        return out if seed else out.withColumn("x1", F.lit(0).cast("long")).withColumn("x2", F.lit(0).cast("long"))

    monkeypatch.setattr(prefix_trie, "prefixes", clashing)
    rows = chatter(random.Random(13), 12)
    assert as_set(prefix_trie.conversation_trie(turns(spark, rows))) == plain_trie(ordered(rows))


def test_slot_table():
    draw = np.random.default_rng(5)
    a, b = draw.integers(-2**62, 2**62, (2, 5000))
    a[:100] = 7  # one half alike
    table = prefix_trie.SlotTable(a, b)
    assert sorted(table.find(a, b)) == list(range(5000))
    assert (table.find(a, b + 1) == -1).all() and len(prefix_trie.SlotTable(a[:0], b[:0]).find(a, b)) == 5000


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, part string, lo long, key string, path string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z", "p") for r in rows], SCHEMA)


def plain_leaf(r, text):
    fields = [r[0], r[3], r[2], r[4], text]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_manifest(rows, fan=8):
    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
    paths = {}

    def raise_up(nodes):
        """(top, path of each position)."""
        at = [[] for _ in nodes]
        groups = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
            for j, g in enumerate(groups):
                run, k = runs[j // fan], j % fan
                for i in g:
                    at[i].append((run[:k], run[k + 1:]))
            groups = [sum(groups[i:i + fan], []) for i in range(0, len(groups), fan)]
            nodes = [sha("".join(run)) for run in runs]
        return nodes[0], at

    tops = {}
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    for p in order:
        leaves = sorted(parts[p])
        tops[p], paths[p] = raise_up([x[2] for x in leaves])
        parts[p] = leaves
    root, upper = raise_up([tops[p] for p in order])
    out = []
    for p, up in zip(order, upper):
        for (filled, key, leaf), path in zip(parts[p], paths[p]):
            out.append((key if filled else None, p, leaf, tops[p], root, path + up))
    return out


@pytest.mark.parametrize("fan", [8, 2])
def test_merkle(spark, fan):
    draw = random.Random(4)
    rows = [(i, draw.choice(["Ab", "c", None, ""]), draw.choices(["en", "de", None, "", "Ä"], [60, 30, 5, 5, 3])[0], draw.choice(["s", None]), draw.choice([1, None]))
            for i in range(300)]
    rows += [(5, "tie", "en", "s", 1)] * 3 + [(5, "other tie", "en", "s", 1), (None, "No key", "en", None, None), (-1, "L" * 300_000, "only", "s", 2), (301, "x", "\U0001F600", "s", 3)]
    got = merkle.verified(docs(spark, rows), changed={"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))}, fan=fan).collect()
    plain = plain_manifest(rows, fan)
    found = sorted((r.key is not None, r.key or 0, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got)
    assert found == sorted((k is not None, k or 0, leaf, top, root, sha("".join("".join(a + b) for a, b in path))) for k, _, leaf, top, root, path in plain)
    text = {(r[0], plain_leaf(r, r[1])): r for r in rows}
    for r in got:
        row = text[(r.key, r.leaf)]
        touched = r.key is not None and r.key % 3 == 0 and row[1] is not None and row[1].lower() != row[1]
        assert r.verified == (not touched) and r.verified == (r.folded_root == r.root)
    some = next(x for x in plain if x[0] is not None and x[0] % 3 == 0 and text[(x[0], x[2])][1] == "Ab")
    have = plain_leaf(text[(some[0], some[2])], "ab")
    for left, right in some[5]:
        have = sha("".join(left) + have + "".join(right))
    assert have in {r.folded_root for r in got if r.key == some[0]}


def test_merkle_small_tables(spark):
    one = merkle.verified(docs(spark, [(1, "t", "en", "s", 1)])).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root and one[0].proof_sha256 == sha("")
    assert merkle.verified(docs(spark, [])).isEmpty()
    same = merkle.verified(docs(spark, [(1, "t", "en", "s", 1)] * 20)).collect()
    assert len(same) == 20 and len({r.root for r in same}) == 1 and all(r.verified for r in same)


PAGES = "page_id long, url string, html string, host string, path string, rule string, verdict string, rid long"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "a", "b", "c", "d", 1) for i, u in enumerate(urls)], PAGES)


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match("[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    path = re.match("[^?#]*", rest[len(raw):])[0]
    fits = []
    for rule, verdict in url_filters.PREFIXES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, *max(fits)[1:]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), rest)
    hit = [v for p, v in url_filters.PATTERNS if re.search(url_filters.rule_regex(p).replace("\\z", "\\Z"), low)]
    return host, path, None, "block" if hit and "allow" not in hit else "allow"


def test_url_filters(spark):
    urls = [None, "", "no scheme.com/", "http://com/", "https://A.Com/x", "https://xcom/", "http://example.com/en/1", "http://www.example.com/en/1",
            "http://m.www.example.com/en/", "http://example.com/EN/1", "http://example.com?en/", "x://a.net/es/1?q#f", "http://net/fr/", "http://a.net/en/1",
            "http://blog.cheap-pills.example.net/en/1", "http://casino-win.example.net/en/1", "http://casino-win.example.net/es/1", "http://big-casino.org/",
            "http://casino.org/", "http://a.org/casino-win", "https://K.org/", "http://ads-track.example.org/a", "http://ads.org", "http://free-bets.org:80/",
            "http://a.org/" + "x/" * 50_000, "http://a.org/\nen?PHPSESSID=1", "http://a.org/?notphpsessid=1", "http://my-gamblers-anonymous.casino-x.org/",
            "http://a.edu/cgi-bin/x", "http://a.org/cgi-bin/x", "http://a.org/q://b.com/", "://", "http://ünï.org/ÄÖ"]
    rows = url_filters.judged(pages(spark, urls + urls[:9])).collect()
    for i, url in enumerate(urls):
        got = [(r.host, r.path, r.rule, r.verdict) for r in rows if r.page_id == i]
        assert got == [plain_verdict(url)], url
    assert len(rows) == len(urls) + 9 and max(r.n_candidates for r in rows) < len(url_filters.PATTERNS) / 3
    kept = url_filters.allowed(pages(spark, urls))
    assert kept.columns == pages(spark, urls).columns
    assert sorted(r.page_id for r in kept.collect()) == [i for i, u in enumerate(urls) if plain_verdict(u)[3] == "allow"]
    assert url_filters.judged(pages(spark, [])).isEmpty()


def test_rule_tokens(spark):
    assert url_filters.rule_tokens("||com/") == ["com"] and url_filters.rule_tokens("casino^") == []
    assert url_filters.rule_tokens("||*-Casino.*net/x") == ["casino"] and url_filters.rule_tokens("/a*b/") == []
    own = spark.createDataFrame([("pen", "block", False), ("", "block", False), (None, "block", False)], "rule string, verdict string, exact boolean")
    rows = url_filters.judged(pages(spark, ["http://OPENER.org/", "http://x.org/"]), url_filters.compiled(own)).collect()
    assert {r.page_id: (r.verdict, r.pattern, r.n_candidates) for r in rows} == {0: ("block", "pen", 1), 1: ("allow", None, 1)}


def test_rarest_token_is_taken(spark):
    urls = ["http://www.example.com/en/1"] * 3 + ["http://www.a.com/"] * 2
    rules = url_filters.compiled(spark.createDataFrame([("||www.example.com/en/", "block", True)], "rule string, verdict string, exact boolean"))
    rows = spark.createDataFrame([(u.split("://")[1],) for u in urls], "address string")
    assert [r.token for r in url_filters.index(rows, rules).collect()] == ["en"]
