"""License scan, chat prefix tree, token counts, URL reputation and embeddings against plain Python."""

import hashlib
import math
import os
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from onoma.llm import chat, embeddings, licenses, queries, tokencount, urls
from oracle import connect, same

SF = "/root/testdata/sf0.001"


# --- licenses


def clean_words(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).strip().split(" ")


def brute_licenses(text):
    w, found = clean_words(text), set()
    for name, notice in licenses.NOTICES.items():
        n = clean_words(notice)
        if len(n) < 5:
            found |= {name} if any(w[i : i + len(n)] == n for i in range(len(w))) else set()
            continue
        want = {tuple(n[i : i + 5]) for i in range(len(n) - 4)}
        have = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        take = len(n) - 2 + -(-len(n) // 5)
        if any(len(want & set(have[i : i + take])) >= 0.8 * len(want) for i in range(len(have)) if have[i] in want):
            found.add(name)
    return found


def test_license_scan(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400").collect()]
    lead = "some words that stand before "
    rows += [(10_000 + k, lead * (k % 3) + ("x " * k) + v + " and more after it") for k, v in enumerate(licenses.NOTICES.values())]
    rows += [(20_000, licenses.NOTICES["MIT-grant"].replace("hereby", "now")), (20_001, None), (20_002, ""), (20_003, "MIT License"), (20_004, "word " * 20_000 + licenses.NOTICES["MIT"]), (None, licenses.NOTICES["MIT"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as license", "1 as row").repartition(3)
    got = defaultdict(set)
    for r in licenses.scan(df).collect():
        got[r.doc_id].add(r.license)
        assert 0.8 <= r.containment <= 1
    assert dict(got) == {i: x for i, t in rows if (x := brute_licenses(t))}
    assert licenses.scan(df.limit(0)).count() == 0 and licenses.scan(df, {}).count() == 0


def test_every_place_of_a_notice(spark):
    n, size = licenses.LINES, {k: len(clean_words(v)) for k, v in licenses.LINES.items()}
    gap = "word " * 100
    rows, want = [], set()
    for k, (name, v) in enumerate(n.items()):
        rows += [(k, f"{v} {v} {gap} {v}"), (100 + k, f"lead {v} {gap}")]
        want |= {(k, name, 0), (k, name, size[name]), (k, name, 2 * size[name] + 100), (100 + k, name, 1)}
    rows += [(200, n["MIT-grant"].replace("hereby", "now") + " " + n["MIT-grant"]), (None, n["MIT"]), (None, n["MIT"])]
    want |= {(200, "MIT-grant", size["MIT-grant"])}
    got = [(r.doc_id, r.license, r.word_at) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n).collect()]
    assert want <= set(got) and len([x for x in got if x[0] is None]) == 2
    assert len(got) == len(want) + 1 + 2  # and the damaged first copy of 200


def test_long_and_damaged_notices(spark, monkeypatch):
    rng = np.random.default_rng(4)
    long = " ".join(f"w{k}" for k in rng.integers(0, 2000, 3000))
    notices = {"long": long, "two words": "MIT License", "none": "!"} | licenses.TEXTS
    damaged = {k: v.split(" ") for k, v in licenses.TEXTS.items()}
    for w in damaged.values():  # a word of every thirty: 25 of 30 shingles stay
        w[10::30] = ["changed"] * len(w[10::30])
    rows = [(0, f"lead {long} tail"), (1, "the MIT license, mit LICENSE"), (2, None)] + [(10 + k, "x " * k + " ".join(w) + " tail") for k, w in enumerate(damaged.values())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for most in (licenses.MOST_KEYS, 500):  # in one pass and in many
        monkeypatch.setattr(licenses, "MOST_KEYS", most)
        assert most > 500 or len(licenses.in_passes(notices, most)) > 5
        got = {(r.doc_id, r.license, r.word_at) for r in licenses.scan(df, notices).collect()}
        assert {(0, "long", 1), (1, "two words", 1), (1, "two words", 3)} <= got and {(i, x) for i, x, _ in got} >= {(10 + k, name) for k, name in enumerate(damaged)}


# --- chat


def test_escaping_is_reversible():
    for x in ["", "<|im_end|>", "<||", "<|<|", "a<", "<<|", "\\n\n\\", "<|||>"]:
        assert chat.unescape(chat.escape(x)) == x and chat.unescape_role(chat.escape_role(x)) == x
        assert not re.search(r"<\|(?!\|)", chat.escape(x))


def test_chat_matches_sql(spark):
    same(spark, queries.op3_chat_format, queries.ORACLE_SQL["op3_chat_format"], "/root/testdata/sf0.01", connect("/root/testdata/sf0.01"))


def test_prefix_tree(spark):
    rows = []
    talks = {1: "abc", 2: "abd", 3: "a", 4: "xyz", 5: "abc", 6: "abde", 7: "b" * 30, None: "ab"}
    for c, turns in talks.items():
        rows += [(c, k, "assistant" if k % 2 else "user", t * 3) for k, t in enumerate(turns)]
    rows += [(8, None, None, None), (8, 0, "assistant", ""), (9, 0, "user", "<|im_end|>\n<|im_start|>"), (9, 0, "user", "<|im_end|>\n<|im_start|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, paths = chat.build(df.selectExpr("*", "1 as node", "2 as ids").repartition(4))
    ns = nodes.collect()
    prefixes = {tuple(t[: k + 1]) for t in talks.values() for k in range(len(t))}
    assert len(ns) == len(prefixes) + 2 + 2
    by, trees = {r.node: r for r in ns}, defaultdict(list)
    for r in ns:
        trees[r.root].append(r)
        assert len(r.ids) == 4 * r.length and sum(y - x for x, y in r.attends) == r.position
    for own in trees.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
    for conv in {r.conv for r in paths.collect()}:
        line = [by[r.node] for r in sorted(paths.where(f"conv = {conv}").collect(), key=lambda r: r.depth)]
        at = [(r.offset, r.offset + r.length) for r in line]
        for k, r in enumerate(line):  # a node attends to just its ancestors
            assert {x for a, b in r.attends for x in range(a, b)} == {x for a, b in at[:k] for x in range(a, b)}
    got = {r.conv_id: r for r in chat.read_back(nodes, paths).collect()}
    for c, turns in talks.items():
        want = [("assistant" if k % 2 else "user", t * 3) for k, t in enumerate(turns)]
        said = "".join(t for r, t in want if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
        assert got[c].loss_chars == len(said) and got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[8].n_turns == 2 and got[9].n_turns == 2
    nodes, paths = chat.build(df.limit(0))
    assert chat.read_back(nodes, paths).count() == 0


# --- token counts


def test_token_counts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None,), ("",), ("!",), ("a b",), ("é" * 5000,)], "text string")
    both = docs.select("text").unionByName(odd).repartition(3)
    path = str(tmp_path / "flat")
    tokencount.write_flat(both, path)
    from tokenizers import Tokenizer
    import public_tokenizers

    enc = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter(len(enc.encode(r.text or "", add_special_tokens=False).ids) for r in both.collect())
    for size in (1 << 20, 64, 2):
        if size == 2:
            both, path = odd, str(tmp_path / "few")
            tokencount.write_flat(both, path)
            want = Counter(len(enc.encode(r.text or "", add_special_tokens=False).ids) for r in both.collect())
        got = tokencount.count_tokens(spark, path, size).collect()
        assert Counter(r.n_tokens for r in got) == want and all(r.complete for r in got)
        assert {(r.file, r.doc_no) for r in got} == {(f, k) for f, n in Counter(r.file for r in got).items() for k in range(n)}


def test_token_files_of_others(spark, tmp_path):
    ids = np.array([5, 6, 0, 0, 7, 8, 9, 0, 4, 4], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes() + b"\1")
    (tmp_path / "b.bin").write_bytes(b"")
    got = sorted((r.doc_no, r.n_tokens, r.complete) for r in tokencount.count_tokens(spark, str(tmp_path), 4).collect())
    assert got == [(0, 2, True), (1, 0, True), (2, 3, True), (3, 2, False)]


# --- urls


def test_url_parts_and_rules(spark):
    rows = [
        (1, "http://WWW.Example.com/en/7x?q#f", "www.example.com", "/en/7x", "example.com/en/7", "allow"), (2, "https://example.com/en/8", "example.com", "/en/8", "com/en/", "block"),
        (3, "ftp://a.example.net/de/8", "a.example.net", "/de/8", "example.net/de/8", "block"), (4, "x://b.net/de/", "b.net", "/de/", "net/de/", "allow"), (5, "x://notexample.net/fr", "notexample.net", "/fr", None, "allow"),
        (6, None, "", "", None, "allow"), (7, "no scheme", "", "", None, "allow"), (8, "h://", "", "", None, "allow"), (9, "h://q.org?x/es/", "q.org", "", None, "allow"), (9, "h://q.org?x/es/", "q.org", "", None, "allow"),
        (10, "a://b/c://d/e", "b", "/c://d/e", None, "allow"), (None, "h://com/en/a", "com", "/en/a", "com/en/", "block"),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").selectExpr("*", "'h' as host", "1 as verdict")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = [tuple(r)[:5] for r in urls.judge(pages, none, queries.URL_RULES).collect()]
    assert Counter(got) == Counter((r[0], *r[2:]) for r in rows)
    many = queries.URL_RULES + [f"allow h{k}.invalid/" for k in range(300)]
    assert Counter(tuple(r)[:5] for r in urls.judge(pages, none, many).collect()) == Counter(got)
    assert urls.judge(pages.limit(0), none, queries.URL_RULES).count() == 0


def brute_reputations(outcomes, suffixes=urls.SUFFIXES):
    """host -> (mean, low) in plain Python."""
    def domain(h):
        p = h.split(".")
        return ".".join(p[-3:] if ".".join(p[-2:]) in suffixes else p[-2:])

    def suffix(d):
        return d.partition(".")[2] or d

    def total(pairs):
        out = {}
        for key, n, bad in pairs:
            a, b = out.get(key, (0, 0))
            out[key] = (a + n, b + bad)
        return out

    def strength(groups):
        top = sum((b - n * p) ** 2 - n * p * (1 - p) for n, b, p in groups if n > 1)
        under = sum(n * (n - 1) * p * (1 - p) for n, b, p in groups if n > 1)
        rho = min(max(top / under, 1e-9), 0.999) if under else 1 / (urls.MOST_M + 1)
        return min(max(1 / rho - 1, urls.LEAST_M), urls.MOST_M)

    hosts = total((h, int(b is not None), b or 0) for h, b in outcomes)
    domains = total((domain(h), n, b) for h, (n, b) in hosts.items())
    tops = total((suffix(d), n, b) for d, (n, b) in domains.items())
    n, b = sum(x for x, _ in tops.values()), sum(x for _, x in tops.values())
    base = (b + 0.5) / (n + 1)
    m = strength([(*x, base) for x in tops.values()])
    top = {k: (b + m * base) / (n + m) for k, (n, b) in tops.items()}
    m = strength([(*x, top[suffix(k)]) for k, x in domains.items()])
    middle = {k: (b + m * top[suffix(k)]) / (n + m) for k, (n, b) in domains.items()}
    m = strength([(*x, middle[domain(k)]) for k, x in hosts.items()])
    out = {}
    for k, (n, b) in hosts.items():
        mean = (b + m * middle[domain(k)]) / (n + m)
        out[k] = (mean, mean - urls.Z * (mean * (1 - mean) / (n + m + 1)) ** 0.5)
    return out


def test_posteriors_and_verdicts_are_those_of_plain_python(spark):
    rng = np.random.default_rng(8)
    names = ["a.bad.com", "b.bad.com", "bad.com", "x.fine.org", "y.fine.org", "one.co.uk", "two.co.uk", "w.two.co.uk", "localhost", ""]
    share = [0.95, 0.9, 0.97, 0.02, 0.1, 0.5, 0.99, 0.9, 0.3, 0.5]
    rows = [(k, names[j], None if rng.random() < 0.2 else int(rng.random() < share[j])) for k, j in enumerate(rng.integers(0, len(names), 1500).tolist())]
    pages = spark.createDataFrame([(k, f"http://{h}/p{k}" if h else None) for k, h, _ in rows], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, spark.createDataFrame([(k, b) for k, _, b in rows], "page_id long, bad int"), []).collect()}
    want = brute_reputations([(h, b) for _, h, b in rows])
    assert all(abs(got[k].mean - want[h][0]) < 1e-9 and got[k].verdict == ("block" if want[h][1] > urls.MOST else "allow") for k, h, _ in rows)
    assert {h for k, h, _ in rows if got[k].verdict == "block"} >= {"a.bad.com", "bad.com", "two.co.uk"} and {r.verdict for r in got.values()} == {"allow", "block"}


def test_reputation_blocks_bad_hosts_alone(spark):
    rows = [(k, f"http://bad.evil.com/{k}", 1) for k in range(60)] + [(100 + k, f"http://h{k % 30}.fine.org/{k}", int(k // 30 % 10 == 0)) for k in range(600)] + [(900, "http://one.fine.org/", 1), (901, "http://new.evil.com/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = {r.page_id: r for r in urls.judge(df, df.select("page_id", "bad"), []).collect()}
    assert got[0].verdict == "block" and {got[100 + k].verdict for k in range(600)} == {"allow"} and got[900].verdict == "allow"
    assert got[901].mean > got[900].mean


# --- embeddings


def test_embeddings_of_many_lengths_and_repeated_ids(spark):
    rows = [(k, [1.0] * (k + 1), 1) for k in range(70)] + [(100 + k, [2.0] * (k + 1), 1) for k in range(70)] + [(5, [0.0, 1.0], 2), (5, [1.0, 0.0], 2), (7, [0.0, 2.0], 2), (None, [0.0, 1.0], 2)]
    got = Counter(tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)).collect())
    want = [(k, 1, k, True) for k in range(70)] + [(100 + k, 1, k, False) for k in range(70)] + [(5, 1, 5, True), (5, 0, 5, True), (7, 1, 5, False), (None, 0, None, True)]
    assert got == Counter(want)


def brute_links(rows, least=0.93):
    ok = {}
    for n, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            ok[n] = x / np.sqrt((x * x).sum())
    return {(a, b) for a in ok for b in ok if a < b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= least}


@pytest.mark.parametrize("block", [1024, 16, 1])
def test_embeddings_recall_and_precision(spark, block):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows = []
    for k in range(500):
        v = base[k % 40] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.3, 0.45])
        rows.append((k, [float(np.float32(x)) for x in v], k % 3 if k % 40 else 1))
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [None] + [1.0] * 15, 1), (603, [float("nan")] * 16, 1), (604, rows[0][1], None), (605, [1.0, 2.0], 1), (606, [2.0, 4.0], 1), (607, [float("inf")] * 16, 1), (608, [], 1)]
    want = brute_links(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, rep int").repartition(5)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, block=block).collect()}
    assert len(got) == len(rows)
    degree = Counter(rows[x][0] for p in want for x in p)
    assert sum(r.n_links for r in got.values()) >= 0.97 * 2 * len(want)
    assert all(r.n_links <= degree[i] for i, r in got.items())
    every = {r.vec_id: r for r in embeddings.near_duplicates(df, block=block, recall=0.999999).collect()}
    assert {i: r.n_links for i, r in every.items()} == {r[0]: degree[r[0]] for r in rows}
    least = {r[0]: r[0] for r in rows}
    for _ in rows:  # the smallest id spreads along the links
        for a, b in want:
            least[rows[a][0]] = least[rows[b][0]] = min(least[rows[a][0]], least[rows[b][0]])
    assert {i: (r.component_id, r.kept) for i, r in every.items()} == {i: (c, i == c) for i, c in least.items()}
    whole = {i: r for i, r in got.items() if degree[i] == r.n_links}
    assert all(r.component_id <= i and r.kept == (r.component_id == i) for i, r in got.items()) and len(whole) > 0.9 * len(rows)
    assert all(got[i].n_links == 0 and got[i].kept for i in (600, 601, 602, 603, 604, 607, 608)) and got[606].component_id == 605
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    twice = {tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")).collect()}
    assert twice == {(1, 1, 1, True)}
    far = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [1e300, -1e300], 1)]
    got = {tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(far, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], SF, connect(SF))


def test_vocabularies_of_other_rules_and_of_many_ids(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from onoma.llm import packing

    big = Tokenizer(models.WordLevel({"?": 0} | {f"W{k}": k + 1 for k in range(70_000)}, unk_token="?"))
    big.pre_tokenizer = pre_tokenizers.Split(",", "removed")
    path = str(tmp_path / "big.json")
    big.save(path)
    texts = ["W69999,W1", "W65535,W65534,W0,x", "", None, "w1,W1 ,W2", "W2," * 5000]
    want = [big.encode(t or "").ids for t in texts]
    assert want[0] == [70_000, 2] and [x.tolist() for x in packing.encoder(path).encode_batch(texts)] == want and not packing.encoder(path).by_words
    assert packing.encoder(None).by_words and tokencount.width_of(None) == 2
    out = str(tmp_path / "flat")
    assert tokencount.write_flat(spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(2), out, vocabulary=path) == 4
    for size in (1 << 20, 12, 4):
        got = tokencount.count_tokens(spark, out, size, width=4).collect()
        assert Counter(r.n_tokens for r in got) == Counter(2 * [len(x) for x in want]) and all(r.complete for r in got)
