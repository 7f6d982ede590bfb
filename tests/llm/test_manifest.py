"""The Merkle manifest against plain trees, for binary and wider trees, and on odd rows."""

import hashlib
import zlib

import duckdb
import pytest
from cases import SCHEMA, documents, frame

from connlens.llm import manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, extra=0):
    doc_id, text, lang, source, n_chars = row[:5]
    fields = (doc_id, source, lang, None if n_chars is None else n_chars + extra, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(leaves, k):
    """(root, per leaf: the runs it passes, as (slot, run))."""
    level, at, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i : i + k] for i in range(0, len(level), k)]
        for path, i in zip(paths, at, strict=True):
            path.append((i % k, runs[i // k]))
        at, level = [i // k for i in at], [digest(*r) for r in runs]
    return level[0], paths


def plain(rows, k):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    names = sorted(langs, key=lambda n: (n is not None, (n or "").encode()))
    trees = []
    for name in names:
        own = sorted(langs[name], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(r))))
        trees.append((own, *tree([leaf(r) for r in own], k)))
    root, tops = tree([t[1] for t in trees], k)
    found = []
    for (own, subroot, paths), top in zip(trees, tops, strict=True):
        for row, path in zip(own, paths, strict=True):
            path = path + top
            others = [d for slot, run in path for i, d in enumerate(run) if i != slot]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf(row, int(hit))
            for slot, run in path:
                folded = digest(*run[:slot], folded, *run[slot + 1 :])
            found.append((row[0], leaf(row), subroot, root, digest(*others), folded, folded == root))
    return sorted(found, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("arity", [2, 3])
def test_odd_rows_as_plain_trees(spark, arity):
    got = manifest.proofs(frame(spark), arity).select(*COLUMNS).collect()
    found = sorted((tuple(r) for r in got), key=repr)
    assert found == plain(documents(), arity)
    assert {r[-1] for r in found} == {True, False}


def test_one_id_on_many_equal_rows(spark):
    rows = [(7, "same", "en", "a", 4)] * 500 + [(i, f"text {i}", "en", "a", 6) for i in range(20)] + [(3, "x", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = manifest.proofs(docs).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 2)


def test_empty_and_single(spark):
    assert manifest.proofs(spark.createDataFrame([], SCHEMA)).count() == 0
    row = documents()[5]
    got = manifest.proofs(frame(spark, [row])).first()
    assert got["root"] == got["subroot"] == got["leaf"] == leaf(row) and got["proof_sha256"] == digest()


def test_sql_on_odd_rows(spark):
    connection = duckdb.connect()
    odd_rows = frame(spark).toArrow()  # noqa: F841 (the name is used by the SQL)
    connection.execute("CREATE TABLE documents AS SELECT * FROM odd_rows")
    cursor = connection.execute(manifest.ORACLE)
    places = [[d[0] for d in cursor.description].index(c) for c in COLUMNS]
    assert sorted((tuple(r[p] for p in places) for r in cursor.fetchall()), key=repr) == plain(documents(), 2)
