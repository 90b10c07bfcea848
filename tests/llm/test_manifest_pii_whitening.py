"""Merkle manifest, personal data and whitening against plain statements of their contracts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from compare import compare
from conftest import SF_DIR
from pyspark.sql import functions as F

from patrona.llm import merkle, pii, queries, whitening


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 Merkle manifest

def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_manifest(docs):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    groups = collections.defaultdict(list)
    for r in docs.collect():
        def leaf(text, r=r):
            return digest("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))
        own = tampered = leaf(r.text)
        if r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            tampered = leaf(re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        groups[r.lang].append((r.doc_id is not None, r.doc_id or 0, own, tampered, r.doc_id))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    upper = tree([trees[g][-1][0] for g in langs])
    rows = []
    for place, g in enumerate(langs):
        for at, row in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            proof, h = "", row[3]
            for levels, j in ((trees[g], at), (upper, place)):
                for level in levels[:-1]:
                    begin = j // 8 * 8
                    run = level[begin:begin + 8]
                    before, after = "".join(run[:j - begin]), "".join(run[j - begin + 1:])
                    proof, h, j = proof + before + after, digest(before + h + after), j // 8
            rows.append((row[4], row[2], trees[g][-1][0], upper[-1][0], digest(proof), h, h == upper[-1][0]))
    return sorted(rows, key=str)


@pytest.mark.parametrize("table", ["edge_docs", "some_docs"])
def test_manifest(table, request):
    docs = request.getfixturevalue(table)
    got = sorted(map(tuple, merkle.manifest(docs).collect()), key=str)
    assert got == plain_manifest(docs)
    assert {r[6] for r in got} == {True, False}


def test_manifest_shapes(spark, edge_docs):
    """Runs of one, exact powers of eight, many languages (a tree of subroots of three levels), one document."""
    rows = [(i, f"Text {i}", f"l{i % 70:02}", "s", i) for i in range(200)]
    rows += [(1000 + i, "Again", None, None, None) for i in range(65)] + [(5000 + i, "x", "deep", "s", 1) for i in range(512)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=str) == plain_manifest(docs)
    alone = docs.limit(1)
    row = merkle.manifest(alone).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == digest("")


def test_manifest_empty(no_docs):
    assert merkle.manifest(no_docs).count() == 0


def test_manifest_equals_sql(spark, duck):
    name = "op11_merkle_manifest"
    assert compare(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLES[name]) is None


# --- 12 personal data

def plain_spans(text):
    text = text or ""
    spans = [(m.start(), m.end(), "email")
             for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        number = [int(c) for c in m[0] if c in "0123456789"]
        if 14 <= len(number) <= 19 and sum(
                d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(number))) % 10 == 0:
            spans.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def as_text(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def random_texts(count, seed):
    rng = random.Random(seed)
    parts = ["a", "B", ".", "@", "@x.y", "1", "25", "256", "00", ".1", " ", "-", "+1", "(", ")", "é", "中", "4111 1111 1111 1111",
             "4845168114407329", "+1 (017) 555-7713", "a@b", "\n", "_", "%", "1.2.3.4", "٣"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(count)]


@pytest.mark.parametrize("table", ["edge_docs", "some_docs", "random"])
def test_pii_base(spark, table, request):
    if table == "random":
        docs = spark.createDataFrame(list(enumerate(random_texts(3000, 5))), "doc_id long, text string")
    else:
        docs = request.getfixturevalue(table)
    texts = docs.select("doc_id", "text").collect()
    got = pii.summarise(pii.find_pii(docs)).collect()
    assert len(got) == len(texts)
    for r, (key, text) in zip(got, texts):
        spans = plain_spans(text)
        assert r.doc_id == key
        kinds = collections.Counter(s[2] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.BASE_KINDS), text
        assert r.base_sha256 == digest(as_text(spans)), text
        kept = [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE_KINDS]
        assert ",".join(kept) == as_text(spans)


@pytest.mark.parametrize("text, kinds", [
    ("Konto DE89 3704 0044 0532 0130 00 Und mehr", ["iban"]),
    ("GB82WEST12345698765432", ["iban"]),
    ("GB82WEST12345698765433", []),
    ("his SSN is 123-45-6789.", ["ssn"]),
    ("part 123-45-6789 of it", []),
    ("SSN 000-45-6789", []),
    ("call me: (030) 555-1234", ["tel"]),
    ("rows (030) 555-1234 of it", []),
    ("DNI 12345678Z", ["id_letter"]),
    ("DNI 12345678A", []),
    ("write to jane.doe (at) mail [dot] example.org", ["email_at"]),
    ("card 3056 930902 590", []),
    ("pay by card 400000000002", ["short_card"]),
    ("order 400000000002", []),
])
def test_pii_method_spans(text, kinds):
    assert [pii.KINDS[s[2]] for s in pii.find_spans(text.encode())] == kinds


def test_pii_context_moves_the_score():
    near = pii.score(b"my phone +1 (017) 555-7713", 9, 26, "phone")
    bare = pii.score(b"so and so +1 (017) 555-7713", 10, 27, "phone")
    against = pii.score(b"version order +1 (017) 555-7713", 14, 31, "phone")
    assert near > bare > against


def test_pii_long_texts_are_linear():
    for text in (b"a" * 400_000, b"@" * 400_000, b"1 " * 200_000, b"1." * 200_000, b"+1" * 200_000, b"a@b" * 130_000,
                 b"A1" * 200_000, b"+1" + b" " * 400_000, b"(at)" * 100_000):
        pii.find_spans(text)


def test_pii_empty_and_redaction(spark, edge_docs, no_docs):
    assert pii.summarise(pii.find_pii(no_docs)).count() == 0
    assert pii.redact_pii(edge_docs).count() == edge_docs.count()
    docs = spark.createDataFrame([(1, "é mail a@b.org, ip 1.2.3.4!", "k"), (2, None, "k")], "doc_id long, text string, x string")
    assert [tuple(r) for r in pii.redact_pii(docs).collect()] == [(1, "é mail [email], ip [ip]!", "k"), (2, None, "k")]


# --- 13 whitening

def plain_whitening(rows, components=16):
    x = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000 for i, (_, v) in enumerate(rows)}
    fitted = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fitted), fitted.sum(0)
    moved = (n * fitted - sums).astype(object)
    cov = (moved.T @ moved) / n ** 3
    values, vectors = np.linalg.eigh(cov.astype(float))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, v in x.items():
        out[i] = (n, int(((n * v - sums).astype(object) ** 2).sum()), (v - sums / n) @ vectors / np.sqrt(values))
    return out, values / np.trace(cov.astype(float))


def test_whitening_against_brute_force(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.orderBy("vec_id").collect()]
    want, explained = plain_whitening(rows)
    got = whitening.whiten_embeddings(vectors).orderBy("vec_id", "component").toPandas()
    assert len(got) == 16 * len(rows)
    table = got["whitened"].to_numpy().reshape(-1, 16)
    plain = np.array([want[i][2] for i in range(len(rows))])
    assert np.abs(table * np.sign((table * plain).sum(0)) - plain).max() < 1e-8
    assert got["deviation"].to_numpy().reshape(-1, 16)[:, 0].tolist() == [want[i][1] for i in range(len(rows))]
    assert set(got["n"]) == {want[0][0]}
    assert np.allclose(got["explained"][:16], explained, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9


def test_polarised_covariance_is_exact(spark):
    """Large entries take the path of unbounded integers; the result stays the exact one, rounded once."""
    rng = random.Random(3)
    x = [[rng.randint(-2 ** 40, 2 ** 40) for _ in range(3)] for _ in range(50)]
    packed = [(np.array(v, "<i8").tobytes(),) for v in x]
    model = whitening.fit(spark.createDataFrame(packed, "x binary"), 3, 3)
    sums = [sum(c) for c in zip(*x)]
    for i in range(3):
        for j in range(3):
            exact = sum((50 * v[i] - sums[i]) * (50 * v[j] - sums[j]) for v in x)
            assert model.covariance[i, j] == exact / 50 ** 3
    assert model.sums == sums and model.n == 50


def test_whitening_edges(spark):
    rows = [(1, [0.5, 1.5]), (1, [0.5, 1.5]), (2, None), (3, []), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (None, [2.0, -1.0]), (8, [1e30, 1.0]), (9, [0.3, 0.1])]
    kind = "vec_id long, embedding array<double>"
    vectors = spark.createDataFrame(rows, kind).withColumn("x", F.lit("y")).withColumn("n", F.lit("z"))
    got = whitening.whiten_embeddings(vectors).collect()
    assert sorted((r.vec_id or -1, r.component, r.n) for r in got) == sorted(
        (k, c, 3) for k in (1, 1, -1, 9) for c in (1, 2))
    assert all(r.whitened is not None and r.identity_error < 1e-9 for r in got)
    assert whitening.whiten_embeddings(spark.createDataFrame(rows[2:6], kind)).count() == 0
    assert whitening.whiten_embeddings(spark.createDataFrame([], kind)).count() == 0
    alone = whitening.whiten_embeddings(spark.createDataFrame(rows[:2], kind)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, 0.0)] * 4
    with pytest.raises(ValueError):
        whitening.whiten_embeddings(spark.createDataFrame(rows, kind), max_dims=1)
