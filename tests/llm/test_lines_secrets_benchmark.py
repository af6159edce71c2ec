import hashlib
import re
from collections import Counter

import duckdb
import pytest

from listinglab.llm import decontaminate, line_dedup, secrets
from listinglab.llm.registry import ORACLE, QUERIES
from tests.llm.conftest import BENCH, SMALL, brute_hits


def brute_lines(rows):
    """Texts after removal of every chunk but its first occurrence. A null id comes first."""
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    first, seen = {}, Counter()
    for has, i, t in order:
        for start, _, content in line_dedup.chunks(t.encode()):
            seen[content] += sum(1 for x in rows if x == (i if has else None, t))
            first.setdefault(content, (has, i, t, start))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        body, kept, at = t.encode(), b"", 0
        for start, end, content in line_dedup.chunks(body):
            if seen[content] > 1 and first[content] != (i is not None, i or 0, t, start):
                kept, at = kept + body[at:start], end
        out.append((i, (kept + body[at:]).decode()))
    return Counter(out)


def test_lines_put_together_are_the_text(messy_rows, small_documents):
    for t in [*[t for _, t, _ in messy_rows], *[t for _, t in small_documents], "a\r\nb\rc\n\n\nd ", "\n\n", "x. y! z"]:
        assert b"".join(line_dedup.lines((t or "").encode())) == (t or "").encode()


@pytest.mark.parametrize("bits", [24, 6])
def test_repeated_chunks_of_hard_cases(messy, messy_rows, bits):
    """Six filter bits let nearly everything through: more is compared, the result is the same."""
    out = line_dedup.drop_repeated_chunks(messy, bits=bits)
    assert out.columns == messy.columns
    rows = [(i, t) for i, t, _ in messy_rows]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == brute_lines(rows)
    assert any(t is not None and n != t for (_, n), (_, t) in zip(sorted(brute_lines(rows), key=str), sorted(rows, key=str), strict=False))


def test_line_hashes_that_collide(messy, messy_rows):
    """Hashes of four bits: the chunks' whole bytes decide."""
    out = line_dedup.drop_repeated_chunks(messy, unit_bits=4)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == brute_lines([(i, t) for i, t, _ in messy_rows])


def test_boundaries_resist_shifts():
    passage = "\n".join(f"line {k} of a passage that stands in several documents" for k in range(20))
    one = {c for _, _, c in line_dedup.chunks(passage.encode())}
    two = {c for _, _, c in line_dedup.chunks(("something before\nand more\n" + passage + "\nafter").encode())}
    assert len(one & two) >= len(one) - 2


def test_planted_passages_go_whole(spark):
    """Passages of 2 to 8 sentences or lines in two documents with different neighbours: no unit of the second copy stays."""
    rows, want = [], []
    for k in range(70):
        n, space, near = 2 + k % 7, " " if k % 2 else "\n", [" ".join(f"n{k}x{j}y{w}" for w in range(9 + j % 3)) + "." for j in range(44)]
        passage = space.join(" ".join(f"p{k}x{j}y{w}" for w in range(2 if j > 1 else 9)) + "." for j in range(n))
        for at, (a, b, c, d) in enumerate([(0, k % 9, 20, 24), (9, 10 + k % 10, 30, 35 + k % 8)]):
            head, tail = space.join(near[a:b]), space.join(near[c:d])
            rows.append((2 * k + at, space.join(filter(None, [head, passage, tail]))))
            want.append((2 * k + at, rows[-1][1] if not at else head + space + tail))
    for k in range(0, len(rows), 2):  # sentences are units of long lines only
        assert k // 2 % 2 == 0 or min(rows[k][1].count(" "), rows[k + 1][1].count(" ")) >= line_dedup.LONG_LINE
    got = line_dedup.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).collect()
    assert {r.doc_id: r.text for r in got} == dict(want)
    before = dict(rows)
    assert all(r.bytes_removed == len(before[r.doc_id]) - len(r.text) for r in got)


def test_line_dedup_against_brute_force(spark, sf, small_documents):
    got = Counter((r.doc_id, r.text) for r in QUERIES["op5_line_dedup"](spark, sf).collect())
    assert got == brute_lines(small_documents)


BASE = {"assign": re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def brute_secrets(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if len(m.group(2) if kind == "assign" else m.group()) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def secret_row(i, text):
    found = brute_secrets(text)
    return (i, *[sum(x[3] == k for x in found) for k in BASE], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest())


TRICKY = ["secret: token = abcdefghijklmnop", "ſecret=abcdefghijklmnop", "api_key='0123456789abcdef' password=short", "AKIAAKIA" + "B" * 20,
          "é" * 50 + "TOKEN=" + "a" * 40, "password:\npassword=aaaaaaaaaaaaaaaa", "0123456789abcdef" * 3 + "G" + "f" * 15]


def test_secrets_of_hard_cases(spark, messy, messy_rows):
    got = Counter(map(tuple, secrets.digest(secrets.scan_paths(messy)).drop("spans").collect()))
    assert got == Counter(secret_row(i, t) for i, t, _ in messy_rows)
    more = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    assert Counter(map(tuple, secrets.digest(secrets.scan_paths(more)).drop("spans").collect())) == Counter(secret_row(i, t) for i, t in enumerate(TRICKY))


def test_secrets_against_brute_force(spark, sf, small_documents):
    got = Counter(tuple(r)[:5] for r in QUERIES["op8_secret_scan"](spark, sf).collect())
    assert got == Counter(secret_row(i, t) for i, t in small_documents)


def test_added_kinds_leave_the_base_alone():
    text = "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM8 -----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36
    assert [k for k, _, _ in secrets.find(text.encode())] == ["jwt", "pem", "pat", "hex"]


def test_the_ledger_scans_only_unseen_pairs(spark, messy, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = Counter(map(str, secrets.scan_paths(messy, ledger).collect()))
    rows = secrets._ledger(spark, ledger).count()
    assert Counter(map(str, secrets.scan_paths(messy, ledger).collect())) == first
    assert secrets._ledger(spark, ledger).count() == rows  # nothing was scanned again
    new = messy.select("doc_id", "text").limit(3).unionByName(spark.createDataFrame([(99, "token = zzzzzzzzzzzzzzzz")], "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in secrets.scan_paths(new, ledger).collect()}
    assert len(found[99]) == 1 and secrets._ledger(spark, ledger).count() == rows + 1
    secrets.scan_paths(messy, ledger, version=2).count()
    assert secrets._ledger(spark, ledger).count() == 2 * rows + 1


def test_a_run_that_died_is_ignored(spark, messy, tmp_path):
    ledger = tmp_path / "ledger"
    want = Counter(map(str, secrets.scan_paths(messy, str(ledger)).collect()))
    for mark in ledger.glob("run-*/_SUCCESS"):
        mark.unlink()
    assert secrets._ledger(spark, str(ledger)) is None
    assert Counter(map(str, secrets.scan_paths(messy, str(ledger)).collect())) == want


@pytest.mark.parametrize("block", [200_000, 12])
def test_contamination_of_hard_cases(messy, messy_rows, bench, block):
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = Counter()
    for i, t, _ in messy_rows:
        words, hit, found = brute_hits(t[:2000] if i == 9 else t, items)
        n = len(re.findall(r"[a-z0-9]+", t)) if i == 9 else len(words)
        want[i, n, len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0] += 1
    assert Counter(map(tuple, decontaminate.contamination(messy, bench, block_words=block).collect())) == want


def test_contamination_matches_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    rel = con.sql(ORACLE["op10_decontaminate"])
    got = Counter(tuple(r[c] for c in rel.columns) for r in QUERIES["op10_decontaminate"](spark, sf).collect())
    assert got == Counter(rel.fetchall())


@pytest.mark.parametrize("mode", ["spans", "documents"])
def test_removal(messy, messy_rows, bench, mode):
    items = [(r.item_id, r.text) for r in bench.collect()]
    out = decontaminate.remove(messy, bench, mode=mode)
    assert out.columns == messy.columns
    got = out.collect()
    clean = [(i, t) for i, t, _ in messy_rows if i == 9 or not brute_hits(t, items)[1]]
    left = Counter((r.doc_id, r.text) for r in got)
    assert not Counter(clean) - left  # every clean row stays as it is
    assert all(not brute_hits(r.text, items)[1] for r in got if r.doc_id != 9)
    if mode == "spans":
        assert {r.text for r in got if r.doc_id == 15} == {"x\ny"}
    else:
        assert left == Counter(clean)


def test_a_document_of_nothing_else_goes(spark, bench):
    docs = spark.createDataFrame([(1, BENCH), (2, "- " + BENCH + " -")], "doc_id long, text string")
    assert decontaminate.remove(docs, bench).count() == 0


def test_empty_tables(empty, messy, bench):
    assert line_dedup.drop_repeated_chunks(empty).count() == 0
    assert secrets.scan_paths(empty).count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0
    none = decontaminate.contamination(messy, bench.limit(0)).collect()
    assert len(none) == messy.count() and not any(r.contaminated for r in none)
    assert decontaminate.remove(empty, bench).count() == 0
