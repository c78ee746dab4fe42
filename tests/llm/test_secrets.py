from __future__ import annotations

import hashlib

import brute
import pytest
from conftest import SF_DIR

from punctua.llm import queries
from punctua.llm.rows import new_folder
from punctua.llm.secrets import BASE_RULES, RULES, Rule, read_ledger, scan_secrets

KEY = "AKIA" + "Z9" * 8
HEX = "0123456789abcdef" * 2


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_query_against_brute_force(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    found = queries.op1_secret_scan(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        spans = brute.base_secrets(texts[r.doc_id])
        assert r.base_sha256 == digest(spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")
        )


@pytest.mark.parametrize(
    "text",
    [
        f"é Token = '{HEX}' {KEY}x{KEY}",
        "api_key: abc token=secret=abcdefgh passwd:'12345' apikey=a.b-c_d",
        "ſecret: abcdefgh toKen: abcdefgh",  # letters that only Unicode folds to s and k
        f"{HEX}g{HEX}G{HEX}" + "x" * 300_000 + KEY,
    ],
)
def test_spans_of_one_text(spark, rows, text):
    df = rows("id int, text string", [(1, text)])
    found = scan_secrets(df, new_folder(df, "t"), rules=BASE_RULES).first().findings
    assert [tuple(s) for s in found] == brute.base_secrets(text)


def test_nulls_repeats_and_clashing_columns(spark, rows):
    data = [(1, f"secret={HEX}", "x"), (1, f"secret={HEX}", "x"), (2, None, "y"), (None, "", "z")]
    df = rows("id int, text string, findings string", data)
    df = df.withColumns({"blob": df.id, "rule": df.id, "row": df.id})
    ledger = new_folder(df, "t")
    found = scan_secrets(df, ledger).collect()
    assert sorted(len(r.findings) for r in found) == [0, 0, 2, 2]
    assert found[0].asDict().keys() == {"id", "text", "blob", "rule", "row", "findings"}
    assert read_ledger(spark, ledger).count() == 2 * len(RULES)  # one for each distinct text
    empty = rows("id int, text string", [])
    assert scan_secrets(empty, new_folder(df, "t")).collect() == []


def test_only_unseen_pairs_are_scanned(spark, rows):
    first = rows("path string, text string", [("a", f"token: {HEX}"), ("b", "plain")])
    ledger = new_folder(first, "t")
    rules = BASE_RULES[:2]
    scan_secrets(first, ledger, rules=rules).collect()
    assert read_ledger(spark, ledger).count() == 4
    # a new version of one file and a copy of an old one: only the new text is scanned
    second = rows("path string, text string", [("a", "plain"), ("b", f"x {KEY}")])
    found = {r.path: r.findings for r in scan_secrets(second, ledger, rules=rules).collect()}
    assert found["a"] == [] and [s.kind for s in found["b"]] == ["access"]
    assert read_ledger(spark, ledger).count() == 6
    # a changed rule sees every text again, and its old findings no longer count
    changed = (rules[0], Rule("access", 2, "plain"))
    found = {r.path: r.findings for r in scan_secrets(second, ledger, rules=changed).collect()}
    assert [s.kind for s in found["a"]] == ["access"] and found["b"] == []
    assert read_ledger(spark, ledger).count() == 8


def test_a_ledger_that_knows_nearly_all_moves_few_texts(spark, rows, monkeypatch):
    """Of 500 texts 495 are known: the others' texts, and none else, leave the scan."""
    from punctua.llm import secrets

    moved = []

    def counted(*args):
        out = with_maybe(*args)
        moved.append(out.filter("maybe").count())
        return out

    with_maybe = secrets.with_maybe
    monkeypatch.setattr(secrets, "with_maybe", counted)
    old = rows("id int, text string", [(i, f"token = {HEX}{i:06d} {'x' * 2000}") for i in range(495)])
    ledger = new_folder(old, "t")
    scan_secrets(old, ledger).collect()
    assert moved == []
    new = old.union(rows("id int, text string", [(i, f"token = {HEX}{i:06d} {'y' * 2000}") for i in range(500, 505)]))
    found = scan_secrets(new, ledger).collect()
    assert len(found) == 500 and all(r.findings for r in found)
    assert 5 <= moved[0] <= 8
    assert read_ledger(spark, ledger).count() == 500 * len(RULES)
    assert len(scan_secrets(new, ledger).collect()) == 500 and moved[1] == 0
