"""Secret scans: patterns against plain searches, and which literals sensitive names hold."""

import hashlib
import random
import re
import time

import pytest

from merchlake.llm import lexing, op13_secrets
from tests.llm import docs as made

HELD = [
    ('db_pwd = "p@ss!w0rd#9"', ["p@ss!w0rd#9"]),
    ('config["password"] = "hunter2!xyz"', ["hunter2!xyz"]),
    ("password: Optional[str] = 'abc123!defg'", ["abc123!defg"]),
    ('A = "sk_live_"\nB = "9aF3kd82LmQ"\nclient_key = A + B', ["sk_live_", "9aF3kd82LmQ"]),
    ('k = "9aF3kd82LmQz"\nsigning_key = k\n', ["9aF3kd82LmQz"]),
    ('k = "9aF3kd82LmQz"\nm = k\nk = "harmless0words"\nsigning_key = m\n', ["9aF3kd82LmQz"]),
    ('A="q9w8e7r6t5"\nprivate_key = f"{A}-1"', ["q9w8e7r6t5", "{A}-1"]),
    ('pwd = "abc1"\npwd += "def2!"\nlogin(pwd)', ["abc1", "def2!"]),
    ('auth = b64decode("cGFzc3dvcmQ5OQ==")', ["cGFzc3dvcmQ5OQ=="]),
    ('x = os.getenv("DB_PASSWORD", "d3fault!pass")', ["d3fault!pass"]),
    ("- name: DB_PWD\n  value: s3cr3t!zz9\n", ["s3cr3t!zz9"]),
    ('<add key="auth" value="Qz81!kk29xm"/>', ["Qz81!kk29xm"]),
    ("<db><pwd>Qz81!kk29xm</pwd></db>", ["Qz81!kk29xm"]),
    ("Authorization: Bearer abc.DEF.123ghi\n", ["abc.DEF.123ghi"]),
    ("postgres://me:pa55w0rd1@host/db", ["pa55w0rd1"]),
    ('connect(user="bob", pwd="tr0ub4dor&3x")', ["tr0ub4dor&3x"]),
    ('{"credentials": {"pwd": "tr0ub4dor&3x"}}', ["tr0ub4dor&3x"]),
    ("# commented: pwd = 'tr0ub4dor&3x'", ["tr0ub4dor&3x"]),
    ("don't auth = 'abcd1234efgh'", ["abcd1234efgh"]),
    # Names that hold no secret, values that are none, names that are overwritten or never used.
    ('key = "9aF3kd82LmQz"\nprint(key)', []),
    ('k = "9aF3kd82LmQz"\nk = "other0words0x"\nlabel = k', []),
    ('token_url = "9aF3kd82LmQz"', []),
    ("export AUTH_TOKEN2=$OTHER\n", []),
    ('passphrase = "correct horse battery"', []),
    ('pwd = "changeme-please"', []),
    ("The auth: something normal here\n", []),
    ('auth = "https://x.org/a1b2c3d4"', []),
    ('auth = input("Type 1 password: ")', []),
    ('auth = "abcd1234efgh', []),
    ("", []),
]


@pytest.mark.parametrize("text,held", HELD)
def test_literals(text, held):
    assert [text[x.start : x.end] for x in lexing.secrets(text)] == held


LONG = ['\\"', '"', "a=(", "token='", "x = a + ", "`'\"", "<a>", '"""', "key=", "://a:", "a-", "key[", "key = a" + " " * 50, "bearer "]


@pytest.mark.parametrize("part", LONG)
def test_work_grows_with_the_text(part):
    """Texts in which nothing closes; a square of their length would take hours."""
    started = time.process_time()
    lexing.secrets(part * 60_000 + "\npwd = 1")
    assert time.process_time() - started < 15


def spans(text):
    """The patterns as the contract words them."""
    assign = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(1)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def test_patterns(spark, folder):
    rng = random.Random(9)
    parts = ["password", "Passwd", "SECRET", "toKen", "apikey", "API_KEY", "ſecret", "toKen", '"', "'", " ", "  ", ":", "=", "abcdef12", "short", "AKIA", "AKIAZZZZ00001111", "0123456789abcdef" * 2, "deadbeef", "😀", "é", "\n", "+/=", "\t"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(400)]
    rows += [(r.doc_id, r.text) for r in made.awkward(spark).collect()]
    made.frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    found = op13_secrets.op13_secrets(spark, folder).collect()
    key = lambda r: (str(r[0]), *r[1:])
    wanted, n_base = [], 0
    for doc, text in rows:
        base = spans(text or "")
        n_base += len(base)
        text = ",".join(f"{op13_secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        wanted.append((doc, *(sum(x[1] == k for x in base) for k in range(3)), hashlib.sha256(text.encode()).hexdigest()))
    assert n_base > 100
    assert sorted(map(key, wanted)) == sorted(key((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256)) for r in found)
    for r in found:
        listed = [x for x in r.spans.split(",") if x and not x.startswith("literal")]
        assert hashlib.sha256(",".join(listed).encode()).hexdigest() == r.base_sha256


def test_added_spans(spark):
    """Literals are added beside what the patterns find, never over it; places are code points."""
    text = "😀 pwd = 'tr0ub4dor&3x'; token = 'abcdef0123456789'"
    rows = [(1, text), (1, text), (None, text), (2, None)]
    found = op13_secrets.scan(made.frame(spark, rows)).collect()
    kinds = [[(x.kind, text[x.start : x.end], x.target) for x in r.findings] for r in found]
    assert kinds[0] == [("literal", "tr0ub4dor&3x", "pwd"), ("assign", "token = 'abcdef0123456789", None)]
    assert kinds[0] == kinds[1] == kinds[2] and kinds[3] == []
    assert op13_secrets.scan(made.frame(spark, rows).filter("false")).count() == 0
