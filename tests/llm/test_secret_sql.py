"""The SQL of op9 against the operator on texts put together from parts of
credentials, so base, weak and linked spans meet in all ways."""

import random

import duckdb
import pyarrow as pa

from ludolake.llm import secret_scan

LOOSE = "aB3dE6gH9jK2mN5pQ8sT1vW4xY7z"
PARTS = ["password = 'hunter22x'", "PassWord:abcdef1", "token=abc", "api-key=1234567", "apikey=1234567", "AKIA" + "Z7" * 8,
         "AKIA" + "Q" * 15, "AKIAAKIA" + "B" * 13, "0123456789abcdef01234567", "0123456789abcdef0123456", LOOSE, LOOSE + "==",
         LOOSE.lower(), "a" * 30 + "B1", "user=bob", "USERNAME: \"al.ice\"", "client-id=x", "client_id=xyz", "superuser=no",
         "https://db.example/x", "x://short", "ftp://ab", "é", "ſecret=abcdefg", "to\u212aen=abcdefg", "\x0b", "\n", "\x1c",
         "secret=token:abcdef", "secret=" + LOOSE, "user=" + LOOSE, "https://h.example/" + LOOSE, "😀 word", "x " * 80, "y " * 110]


def test_digest_equals_its_sql(spark):
    pick = random.Random(9)
    texts = ["".join(pick.choice(PARTS) + pick.choice([" ", "", "  ", "\n", "; "]) for _ in range(pick.randrange(1, 12)))
             for _ in range(400)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], None), (None, None, "a"), (3, "", "b"), (3, texts[3], "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)
    got = sorted(map(str, (tuple(r) for r in secret_scan.digest(secret_scan.find(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect())))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]}))
    want = sorted(map(str, con.execute(secret_scan.ORACLE).fetchall()))
    assert got == want
    assert sum("login" in x for x in want) > 20 and sum("loose_secret" in x for x in want) > 20


def test_sql_of_an_empty_table():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    assert con.execute(secret_scan.ORACLE).fetchall() == []
