"""Source audit, WARC archives and vector codes against brute force, and on awkward tables."""

import base64
import gzip
import hashlib
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from hazemill.llm import queries, source_audit, vector_codes, warc
from hazemill.llm.transducer import Transducer
from hazemill.session import scratch_path
from tests.conftest import rows

CLASHING = "n bigint, key string, value int, item int, p int, none int, ordinal int, gid int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


# Transducer


def strings(n, seed):
    rng = np.random.default_rng(seed)
    found = {bytes(rng.integers(97, 101, rng.integers(0, 7)).tolist()) for _ in range(n)}
    return sorted(found | {"été".encode(), "étés".encode(), b"z" * 500, "日本".encode()})


def test_transducer_gives_ordinals_and_strings():
    known = strings(800, 1)
    built = Transducer.from_bytes(Transducer.build(known).to_bytes())
    assert built.ordinals(known).tolist() == list(range(len(known)))
    others = [s + b"!" for s in known] + [s[:-1] + b"\xff" for s in known if s]
    assert set(built.ordinals(others).tolist()) == {-1}
    assert [built.string(i) for i in range(len(known))] == known


def test_transducer_is_minimal():
    known = strings(600, 2)
    built = Transducer.build(known)
    # States of the smallest automaton: different sets of rests.
    rests = {}
    for s in known:
        for i in range(len(s) + 1):
            rests.setdefault(s[:i], set()).add(s[i:])
    assert len(built.final) == len({frozenset(r) for r in rests.values()})


def test_transducer_without_strings():
    built = Transducer.from_bytes(Transducer.build([]).to_bytes())
    assert built.ordinals([b"", b"a"]).tolist() == [-1, -1]
    assert Transducer.build([b""]).ordinals([b"", b"a"]).tolist() == [0, -1]


# Source audit


def audit(data, least, top=10):
    """Rows of the audit by dense sums over (lang, source, text)."""
    data = [(lang or "", source or "", [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]) for lang, source, text in data]
    result = []
    for lang in {d[0] for d in data}:
        documents = Counter(t for d in data if d[0] == lang for t in set(d[2]))
        kept = sorted((t for t, n in documents.items() if n >= least), key=str.encode)

        def shares(counts):
            total, kinds = sum(counts[t] for t in kept), len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * kinds) for t in kept}

        counts = {s: Counter(t for d in data if d[:2] == (lang, s) for t in d[2]) for s in {d[1] for d in data if d[0] == lang}}
        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                result += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(result, key=repr)


def audited(seed, n=160):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "été", "ÉTÉ", "naïve", "x1y2", "a", "b", "日本", "zz-top", " q", "don't", "end"]
    data = []
    for i in range(n):
        text = " ".join(words[j] for j in rng.integers(0, len(words), rng.integers(0, 25)))
        data.append((["en", "de", None][i % 3], f"s{min(int(rng.integers(0, 9)), 5)}", text))
    data += [("en", "s0", "hot " * 5000), ("en", None, None), ("xx", "none", "once only"), ("xx", "also", ""), (None, "", "the"), *data[:5]]
    return data


def table(spark, data):
    extra = [(*d, i, *["clash"], *range(6)) for i, d in enumerate(data)]
    return spark.createDataFrame(extra, f"lang string, source string, text string, {CLASHING}").repartition(5)


@pytest.mark.parametrize("part_terms", [200_000, 4])
def test_audit(spark, part_terms, monkeypatch):
    monkeypatch.setattr(source_audit, "PAIRED", 7)
    data = audited(3)
    found = source_audit.audit_sources(table(spark, data), min_documents=3, part_terms=part_terms)
    assert rows(found) == audit(data, 3)


def test_audit_flushes_and_cuts_texts(spark, monkeypatch):
    texts = ["ab " * 50 + "x" * 300 + " cd" * 9, "x" * 900, " " * 700, "a b", "", None]
    monkeypatch.setattr(source_audit, "PIECE", 64)
    for text in texts:
        assert [t for p in source_audit.pieces((text or "").encode()) for t in p] == (text or "").encode().split()
    data = [("en", f"s{i % 4}", " ".join(f"t{chr(97 + (i * j) % 23)}" for j in range(60))) for i in range(60)]
    vocabulary = source_audit.Vocabulary.build(source_audit.vocabulary(source_audit._texts(table(spark, data)), 2), 5)
    assert len(vocabulary.first) > 1 and [vocabulary.term(i) for i in range(3)] == sorted({t for d in data for t in d[2].split()})[:3]


def test_audit_of_no_rows(spark):
    empty = table(spark, audited(1, 3)).limit(0)
    assert source_audit.audit_sources(empty).count() == 0


def test_shares_beyond_64_bits(spark):
    count = 3 * 10**15
    found = spark.range(1).select(source_audit.share(f"{count}L", f"{count * 2}L", "5L")).first()[0]
    assert found == 1 + 10**9 * (count + 2) // (2 * count + 10)


# WARC


def pages(spark, data):
    extra = [(*d, 1, "x") for d in data]
    return spark.createDataFrame(extra, "page_id bigint, url string, html string, shard int, payload string").repartition(4)


PAGES = [
    (1, "http://a.example/ 1", "<p>one</p>"), (2, "http://a.example/2\r\nWARC-Type: x", "<p>two</p>\r\n\r\nWARC/1.1\r\n"), (3, None, "<p>one</p>"), (4, "u", None),
    (5, "u", ""), (None, "v", "<p>one</p>"), (6, "w", "é日本" * 4000), (7, "w", "é日本" * 4000), (-8, "neg", "<p>two</p>\r\n\r\nWARC/1.1\r\n"),
    (9, "r", "again"), (9, "r", "again"), (9, "q", "again"), (9, "q", "other"), (10, "long", "x" * 3_000_000), (None, None, None),
]


def archived(data, least=0):
    """page_id, bytes, digest, type and refers_to of each page."""
    seen, result = {}, []
    for page_id, _, html in sorted(data, key=lambda p: (p[0] is None, p[0] or 0)):
        payload = (html or "").encode()
        first = payload not in seen or len(payload) < least
        seen.setdefault(payload, page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        result.append((page_id, len(payload), digest, "response" if first else "revisit", None if first else seen[payload]))
    return sorted(result, key=repr)


RESULT = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("least", [0, 8])
def test_archive(spark, least):
    path = warc.write_archive(pages(spark, PAGES), scratch_path(spark, "warc"), min_bytes=least)
    found = warc.read_archive(spark, path)
    assert rows(found.select(*RESULT)) == archived(PAGES, least)
    texts = {(r.page_id, bytes(r.payload)) for r in found.filter("record_type = 'response'").collect()}
    assert {t for _, t in texts} == {(p[2] or "").encode() for p in PAGES}


def test_archive_is_rolled_sorted_and_deterministic(spark, monkeypatch):
    monkeypatch.setattr(warc, "part_bytes", lambda total: 20_000)
    rng = np.random.default_rng(4)
    data = [(i * 7 % 400, f"http://h.example/{i}", rng.bytes(150).hex()) for i in range(400)]
    kept = []
    for parts in (2, 5):
        path = warc.write_archive(pages(spark, data).repartition(parts), scratch_path(spark, "warc"), file_bytes=4000)
        files = warc.manifest(spark, path).orderBy("shard", "sequence").collect()
        kept.append([(f.file, f.sha256, f.bytes, f.records) for f in files])
        on_disk = {p.name: p.read_bytes() for p in Path(path.removeprefix("file:")).glob("*.warc.gz")}
        assert {f.file: f.sha256 for f in files} == {n: hashlib.sha256(b).hexdigest() for n, b in on_disk.items()}
    assert kept[0] == kept[1]
    assert len({f.shard for f in files}) > 2 and max(f.sequence for f in files) > 0
    assert all(f.bytes <= 4000 or f.records == 1 for f in files)
    ids = [int(m) for f in files for m in re.findall(rb"WARC-Record-ID: <urn:page:(\d+)>", gzip.decompress(on_disk[f.file]))]
    assert ids == sorted(ids) and len(ids) == 400


def test_archive_reads_only_its_manifest_and_verifies(spark):
    path = warc.write_archive(pages(spark, PAGES), scratch_path(spark, "warc"))
    folder = Path(path.removeprefix("file:"))
    whole = sorted(folder.glob("*.warc.gz"))[0]
    (folder / "pages-999999-00000.warc.gz").write_bytes(whole.read_bytes())
    (folder / ".pages-000000-00000.warc.gz-draft").write_bytes(b"torn")
    assert warc.read_archive(spark, path).count() == len(PAGES)
    whole.write_bytes(gzip.compress(gzip.decompress(whole.read_bytes()).replace(b"<p>one", b"<p>ONE")))
    with pytest.raises(Exception, match="digest|broken record"):
        warc.read_archive(spark, path).collect()


def test_archive_of_no_pages(spark):
    path = warc.write_archive(pages(spark, PAGES).limit(0), scratch_path(spark, "warc"))
    assert warc.manifest(spark, path).count() == 0 and warc.read_archive(spark, path).count() == 0


def test_many_copies_of_one_page(spark):
    data = [(i, "u", "same") for i in range(300)] + [(1000, "k", "p")] * 300 + [(2000 + i, "u", f"own{i}") for i in range(50)]
    path = warc.write_archive(pages(spark, data), scratch_path(spark, "warc"))
    assert rows(warc.read_archive(spark, path, payloads=False).select(*RESULT)) == archived(data)


# Vector codes


def coded(data):
    kept = [(v, np.floor(np.clip(np.array(e, np.float64), -(2.0**30), 2.0**30) * 1024), label) for v, e, label in data if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    width = -(-max((len(r[1]) for r in kept), default=0) // 4) * 4
    ints = [[int(x) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    codes, errors, books = [""] * len(kept), [0] * len(kept), []
    for k in range(4):
        parts = [v[k * width // 4 : (k + 1) * width // 4] for v in ints]
        book = [list(p) for p in parts[:256]]

        def nearest(book=book, parts=parts):
            return [min((sum((a - b) ** 2 for a, b in zip(p, c)), e) for e, c in enumerate(book)) for p in parts]

        for _ in range(4):
            found = nearest()
            for e in range(len(book)):
                own = [p for p, (_, at) in zip(parts, found) if at == e]
                book[e] = [sum(x) // len(own) for x in zip(*own)] if own else book[e]
        for i, (gap, e) in enumerate(nearest()):
            codes[i] += f"{e:02x}"
            errors[i] += gap
        books.append(book)
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    errors = [min(e, 2**63 - 1) for e in errors]
    sums = Counter()
    for (_, _, label), e in zip(kept, errors):
        sums[label] += e
    return sorted([(r[0], codes[i], errors[i], min(sums[r[2]], 2**63 - 1), digest) for i, r in enumerate(kept)], key=repr)


def vectors(spark, data, kind="float", label="int"):
    extra = [(*d, 1, "c", 2) for d in data]
    return spark.createDataFrame(extra, f"vec_id bigint, embedding array<{kind}>, label {label}, part int, code string, error int").repartition(3)


def cluster(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    return [(int(i), np.float32(centres[i % 9] + rng.normal(scale=0.2, size=width)).tolist(), [None, 1, 2][i % 3]) for i in range(n)]


AWKWARD = [
    (None, [0.5] * 8, 1), (3, None, 1), (4, [1.0, None] * 4, 1), (5, [float("nan")] * 8, 2), (6, [float("inf")] * 8, 2),
    (7, [], 2), (8, [-0.0004] * 3, None), (9, [0.25] * 8, None), (9, [0.25] * 8, None), (9, [-0.25] * 8, None),
]


def test_codes(spark):
    data = cluster(700, 24, 5)
    assert rows(vector_codes.compress_vectors(vectors(spark, data))) == coded(data)


@pytest.mark.parametrize("data", [AWKWARD, AWKWARD + [(20, [1e9, -3e300] + [0.5] * 7, 4), (21, [1e7] * 9, 4)], [(1, [], "a")], [(1, [float(2**29)] * 8, 1), (2, [-float(2**29)] * 8, 1), (1, [1.0] * 8, 1)]])
def test_codes_of_awkward_vectors(spark, data):
    label = "string" if data == [(1, [], "a")] else "int"
    assert rows(vector_codes.compress_vectors(vectors(spark, data, "double", label))) == coded(data)


def test_codes_of_no_vectors(spark):
    assert vector_codes.compress_vectors(vectors(spark, AWKWARD).limit(0)).count() == 0
    assert vector_codes.compress_vectors(vectors(spark, AWKWARD[1:5])).count() == 0


def test_walsh_keeps_distances_and_sequency():
    rng = np.random.default_rng(6)
    x = rng.integers(-1000, 1000, (2, 11))
    a, b = vector_codes.walsh(x)
    assert ((a - b) ** 2).sum() == 16 * ((x[0] - x[1]) ** 2).sum()
    basis = vector_codes.walsh(np.eye(16, dtype=np.int64)).T
    assert [int((np.diff(r) != 0).sum()) for r in basis] == list(range(16))


def test_queries_have_sql():
    assert {"op11_transducer_audit", "op12_warc_shards", "op13_walsh_codes"} <= set(queries.ORACLES)
