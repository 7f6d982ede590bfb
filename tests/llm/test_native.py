"""Licence scan, URL filter, mix and quality rules against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from connlens.llm import licences, mixing, quality, urls
from connlens.llm.plans import QUERIES

from cases import documents, frame, plain

BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Licences


def test_licences(spark):
    mit = dict(licences.LICENCES[::-1])["MIT"]
    rows = [
        (1, licences._MIT), (2, "MIT Licence\n\nCopyright (c) 2020 Someone\n\n" + licences._MIT.upper()), (3, licences._MIT + " more"),
        (4, "/* © 1999 A\n * All rights reserved. */\n" + licences._MIT.replace(",", " ,").replace("sublicense", "sub-license")),
        (5, licences._BSD_TERMS.format(licences._BSD_THIRD)), (6, "licensed under the apache licence, version 2.0"), (7, None), (8, ""),
        (9, "Copyright 2001"), (None, mit), (1, licences._MIT), (10, "word " * 50_000),
    ]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, digest string, licence string")
    found = Counter((r.doc_id, r.licence) for r in licences.scanned(docs).collect())
    wanted = {1: "MIT", 2: "MIT", 4: "MIT", 5: "BSD-3-Clause", 6: "Apache-2.0", None: "MIT"}
    assert found == Counter((d, wanted.get(d)) for d, _ in rows)
    assert licences.scanned(docs.limit(0)).collect() == []


def test_licence_query_takes_all_documents(spark, data):
    assert QUERIES["op2_licence_scan"](spark, data).count() == spark.read.parquet(f"{data}/documents.parquet").count()


# URLs


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def symbols(host, path):
    text = "".join(c.lower() if "A" <= c <= "Z" else "0" if c in "123456789" else c for c in host + path)
    return re.sub(r"[^a-z0./_:-]", "~", text) + "$"


class PlainModel:
    """Witten-Bell models of both classes, by dictionaries."""

    def __init__(self, training, how):
        self.order, size = how.order, len(urls.ALPHABET)
        self.counts = [defaultdict(Counter), defaultdict(Counter)]
        for text, rejected in training:
            padded = "^" * self.order + text
            for i, c in enumerate(text):
                for k in range(self.order + 1):
                    self.counts[rejected][padded[i + self.order - k : i + self.order]][c] += 1
        self.size = size
        self.kept = {x for x in {*self.counts[0], *self.counts[1]} if sum(sum(c.get(x, {}).values()) for c in self.counts) >= how.seen}

    def chance(self, rejected, context, char):
        low = self.chance(rejected, context[1:], char) if context else 1 / self.size
        seen = self.counts[rejected].get(context, {})
        n = sum(seen.values())
        return (seen.get(char, 0) + len(seen) * low) / (n + len(seen)) if n else low

    def score(self, text):
        padded, total = "^" * self.order + text, 0
        for i, c in enumerate(text):
            context = next(x for k in range(self.order, -1, -1) if (x := padded[i + self.order - k : i + self.order]) in self.kept)
            total += round(1e6 * (math.log(self.chance(1, context, c)) - math.log(self.chance(0, context, c))))
        return total / len(text)


def pages(spark, data):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    odd = [None, "", "no scheme", "http://", "HTTPS://A.EXAMPLE.NET/en/x?y#z", "http://net/a", "http://net", "ftp://b.org/fr/?q", "x://example.com/de/"]
    odd += ["http://evilexample.net/en/", "http://a.net:80/", "http://é.org/fr/ü\n", "a://b://net/", "http://x.com/" + "long" * 3000]
    return [*rows, *((10_000 + i, u) for i, u in enumerate(odd)), (None, "http://q.com/"), rows[0], rows[0]]


def test_urls_against_plain_model(spark, data):
    rows, how = pages(spark, data), urls.Model()
    table = spark.createDataFrame([(*r, "h", "s") for r in rows], "page_id long, url string, host string, score string").repartition(3)
    found = urls.judged(table).collect()
    assert len(found) == len(rows)
    split_rows = [(i, *parts(u)) for i, u in rows]
    held_out = lambda s: hashlib.md5(s.encode()).hexdigest()[0] < "3"
    labelled = [(symbols(h, p), rule(h, p)[1] == "block") for _, h, p in split_rows if rule(h, p)[1]]
    model = PlainModel([x for x in labelled if not held_out(x[0])], how)
    clean = sorted((math.ceil(model.score(s) / 1000) for s, bad in labelled if held_out(s) and not bad), reverse=True)
    limit = next((b * 1000.0 for i, b in enumerate(clean) if sum(x >= b for x in clean) > how.loss * len(clean)), None)
    wanted = []
    for i, h, p in split_rows:
        name, verdict = rule(h, p)
        score = model.score(symbols(h, p))
        wanted.append((i, h, p, name, verdict or ("block" if limit is not None and score > limit else "allow"), round(score / 1e6, 9)))
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.score, 9)) for r in found), key=repr) == sorted(wanted, key=repr)


def test_url_model_tells_held_out_urls_apart(spark, data):
    found = urls.judged(spark.read.parquet(f"{data.replace('0.001', '0.01')}/pages.parquet")).filter("rule IS NOT NULL")
    right = [(r.score > 0) == (r.verdict == "block") for r in found.collect()]
    assert sum(right) > 0.9 * len(right)


def test_rare_words_of_urls_are_learnt(spark):
    """A word in two of many thousand training URLs, beside hosts that have all other characters."""
    same = [(i, f"http://site{i % 7}.{'net' if i % 2 else 'org/fr'}/page") for i in range(4000)]
    rare = [(9000 + i, "http://qqq.net/page") for i in range(40)] + [(9500, "http://qqq.com/page"), (9501, "http://site3.com/page")]
    table = spark.createDataFrame([*same, *rare], "page_id long, url string")
    training = urls.with_parts(table).withColumn("symbols", urls._symbols()).filter("page_id < 9500")
    tables = urls.fitted(training.selectExpr("symbols", "host LIKE '%net' AS rejected"), urls.Model())
    kept = {r.context for r in tables[3].select("context").distinct().collect()}
    assert {"qqq", "q.n"} <= kept


def test_urls_with_larger_tables_than_are_broadcast(spark, data, monkeypatch):
    table = spark.read.parquet(f"{data}/pages.parquet")
    wanted = sorted(map(tuple, urls.judged(table).collect()), key=repr)
    monkeypatch.setattr(urls, "broadcast_if_small", lambda df: df)
    assert sorted(map(tuple, urls.judged(table).collect()), key=repr) == wanted


def test_urls_without_examples(spark):
    table = spark.createDataFrame([(1, "http://x.com/"), (2, "http://a.net/b")], "page_id long, url string")
    assert plain(urls.judged(table), "page_id", "verdict") == [(1, "allow"), (2, "block")]
    assert urls.judged(table.limit(0)).collect() == []


# Mix


def test_mix(spark):
    rows, mix = documents(), mixing.Mix()
    sizes = [len(split(r[1])) for r in rows]
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    own = {s: sum(n for n, r in zip(sizes, rows, strict=True) if r[3] == s) for s in order}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    rest = 1.5 * sum(sizes)
    while True:  # plain water-filling, one overflow after the other
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * own[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * own[s]
            rest -= target[s]
        open_ -= over
    target.update({s: level * weight[s] for s in open_})
    found = mixing.takes(frame(spark)).collect()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r[0], n) for r, n in zip(rows, sizes, strict=True))
    source = {r[0]: r[3] for r in rows}
    assert all(math.isclose(r.target, target[source[r.doc_id]]) and r.source_size == own[source[r.doc_id]] for r in found if r.doc_id is not None)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in found)
    for s in order:
        taken = sum(r.taken for r in found if r.doc_id is not None and source[r.doc_id] == s)
        largest = max(n for n, r in zip(sizes, rows, strict=True) if r[3] == s)
        assert abs(taken - target[s]) <= largest + 60
    again = mixing.takes(frame(spark)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)
    mixed = mixing.mixed(frame(spark), mix)
    assert mixed.columns == frame(spark).columns
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter({i: sum(r.repeats for r in found if r.doc_id == i) for i in source})


def test_mix_with_one_id_on_many_rows(spark):
    """Each source comes within a document or two of its target, though one id holds most rows of a source."""
    rows = [(7 if i % 2 else i, f"w{i} " * 40, "en", "a", 0, 0, "", 0, "") for i in range(400)]
    rows += [(1000 + i, f"v{i} " * 40, "en", s, 0, 0, "", 0, "") for i in range(100) for s in ("b", "c")]
    docs = frame(spark, rows)
    goals = mixing.targets(mixing._sized(docs, mixing.Mix(), "text", "source", "doc_id"), mixing.Mix()).collect()
    taken = Counter()
    for r in mixing.mixed(docs).collect():
        taken[r.source] += 40
    assert len(goals) == 3
    assert all(abs(taken[r.key[1:]] - r.target) <= 80 for r in goals)


def test_mix_of_many_sources_meets_targets(spark, data):
    folder = data.replace("0.001", "0.1")
    found = QUERIES["op4_source_mix"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source")
    sums = found.join(docs, "doc_id").groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert len(sums) == 20
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] for r in sums)


def test_mix_of_nothing(spark):
    assert mixing.takes(frame(spark, [])).collect() == []
    empty = [(i, None, "en", s, 0, 0, "", 0, "") for i, s in enumerate(("a", "b", None))]
    assert {(r.taken, r.target) for r in mixing.takes(frame(spark, empty)).collect()} == {(0, 0.0)}


# Quality


def counts(text):
    words = split(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def plain_verdicts(rows, labels, promise):
    good = {d for d in {d for d, _ in labels} if {q for e, q in labels if e == d and q is not None} == {1}}
    base = {i: (c := counts(r[1]))[0] < 50 or 100 * c[4] > 50 * c[0] for i, r in enumerate(rows)}

    def beyond(rule, j, c):
        name, sign, cuts = quality.RULES[rule]
        value = 1000 * dict(zip(quality.COUNTS, c, strict=True))[name]
        return value > cuts[j] * c[0] if sign > 0 else value < cuts[j] * c[0]

    held = defaultdict(list)
    for i, r in enumerate(rows):
        if not base[i] and r[0] in good:
            held[r[2]].append(counts(r[1]))
    level = promise.error / max(1, len(held) * len(quality.RULES))
    used = {}
    for stratum, found in held.items():
        for name, (_, _, cuts) in quality.RULES.items():
            n = len(found)
            for j in range(len(cuts)):
                k = sum(beyond(name, j, c) for c in found)
                tail = sum(math.comb(n, i) * promise.risk**i * (1 - promise.risk) ** (n - i) for i in range(k + 1))
                if k >= n * promise.risk or tail > level:
                    break
                used[stratum, name] = j
    return [
        (r[0], *counts(r[1]), base[i], not base[i] and not any(beyond(x, j, counts(r[1])) for (s, x), j in used.items() if s == r[2]))
        for i, r in enumerate(rows)
    ], used


@pytest.mark.parametrize("promise", [quality.Risk(), quality.Risk(0.3, 0.4)])
def test_quality(spark, promise):
    rows = documents()
    labels = [(r[0], int(i % 7 > 0)) for i, r in enumerate(rows) if i > 15] + [(3, None), (20, 0), (20, 1), (None, 1)]
    table = spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int")
    wanted, used = plain_verdicts(rows, labels, promise)
    found = quality.judged(frame(spark), table, promise=promise)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert bool(used) == (promise.risk > 0.1)
    kept = quality.accepted(frame(spark), table, promise=promise)
    assert kept.columns == frame(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(w[0] for w in wanted if w[-1])


def test_quality_of_nothing(spark):
    table = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judged(frame(spark, []), table).collect() == []
    assert all(r.kept == (not r.base_failed) for r in quality.judged(frame(spark), table).collect())


def test_binomial_tail(spark):
    rows = [(k, n) for n in (1, 5, 20, 21, 100, 1000) for k in (0, 1, 3, 9) if k <= n]
    found = spark.createDataFrame(rows, "k long, n long")
    from pyspark.sql import functions as F

    for r in found.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect():
        exact = sum(math.comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1))
        assert math.isclose(r.p, exact if r.k < r.n * 0.02 else 1.0, rel_tol=1e-9)
