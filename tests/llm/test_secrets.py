import base64
import bz2
import gzip
import hashlib
import random
import re
import zlib
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secrets

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
KEY = "AKIA" + "Q7" * 9


def spans(text):
    return secrets.scan(text)[1]


def test_base_equals_the_patterns(spark, tiny):
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    texts[10**6] = "é API_Key = 'abcdef', apikey:abc token=abcdef1 toKEN :zz toſen=abcdefg pasſword=aaaaaaaa " + "a1" * 12 + "F" + "0" * 24 + " AKIA12 " + KEY + "z"
    extra = spark.createDataFrame([(10**6, texts[10**6], None, None, None)], COLUMNS)
    for r in secrets.digest_columns(secrets.find_secrets(docs.union(extra))).collect():
        text = texts[r.doc_id]
        found = [[(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]]
        found.append([(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20])
        found.append([(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, found))
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(x for f in found for x in f))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_layers_map_to_their_place():
    plain = "password=hunter2abc"
    for encode in (
        lambda t: "".join(f"%{b:02X}" for b in t.encode()),
        lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
        lambda t: "".join(f"&#{ord(c)};" for c in t),
        lambda t: "".join(f"&#x{ord(c):x};" for c in t),
    ):
        text = "é " + encode(plain) + " tail"
        assert (2, 2 + len(encode(plain)), "assign") in spans(text)
    # Only the sign is encoded: the span runs from the word to the end of its value.
    assert spans("a password%3Dhunter2abc b") == [(2, 23, "assign")]
    token = base64.b64encode(f"xx {plain}".encode()).decode()
    start, end, kind = spans(f"see {token}!")[0]
    assert kind == "assign" and 4 <= start <= 4 + 4 and end <= 4 + len(token)
    for pack in (gzip.compress, zlib.compress, bz2.compress):
        token = base64.b64encode(pack(f"{plain} and more".encode())).decode()
        assert (4, 4 + len(token.rstrip("=")) + token.count("="), "assign") in spans(f"see {token}")


def test_token_in_a_path_and_packed_url():
    token = base64.b64encode(b"secret=abcdefghij").decode().rstrip("=")
    text = f"https://host.example/long/path/{token}/x"
    assert [s[2] for s in spans(text)] == ["assign"] and text.index(token) <= spans(text)[0][0]
    packed = "".join(f"%{b:02x}" for b in gzip.compress(b"secret=abcdefghij and so on"))
    assert (2, 2 + len(packed), "assign") in spans(f"a {packed} b")


def test_nested_to_the_fixpoint():
    text = f"key {KEY} end"
    for n in range(6):
        wrap = [lambda t: base64.b64encode(t.encode()).decode(), lambda t: quote(t, safe=""), lambda t: base64.urlsafe_b64encode(gzip.compress(t.encode())).decode(), lambda t: "".join(f"\\u{ord(c):04x}" for c in t)]
        text = wrap[n % 4](text)
    base, found, layers = secrets.scan(f"before {text} after")
    assert not [s for s in base if s[2] == "access"] and layers >= 4
    (start, end, _), = [s for s in found if s[2] == "access"]
    assert 7 <= start < end <= 7 + len(text)


def test_cycles_and_broken_layers_end():
    for text in ("%25" * 50 + "41", "%zz %", "\\uD800\\u12", "&#99999999;", "A" * 40, base64.b64encode(b"\x1f\x8b broken").decode(), base64.b64encode(gzip.compress(b"\0" * 100)).decode()):
        secrets.scan(text)
    bomb = base64.b64encode(gzip.compress(b"a" * 5000)).decode()
    assert secrets.scan(bomb, limit=1000)[2] == 0 and secrets.scan(bomb, limit=10_000)[2] == 1


def test_table(spark):
    long = "word " * 200_000 + "secret: abcdefgh"
    rows = [(1, None, None, None, None), (2, "", "x", "y", 0), (3, "token=abcdef é", "x", "y", 14), (3, "token=abcdef é", "x", "y", 14), (None, KEY, None, None, 1), (5, long, None, None, 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = secrets.digest_columns(secrets.find_secrets(docs.withColumn("spans", F.lit(1)).withColumn("base", F.lit(1)))).collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == sorted([("1", ""), ("2", ""), ("3", "assign:0:12"), ("3", "assign:0:12"), ("None", f"access:0:{len(KEY)}"), ("5", "assign:1000000:1000016")])
    clean = secrets.redacted(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in clean if r.doc_id != 5) == sorted([("1", None), ("2", ""), ("3", "[SECRET] é"), ("3", "[SECRET] é"), ("None", "[SECRET]")], key=str)
    assert {r.doc_id: r.n_chars for r in clean}[3] == 10
    assert secrets.find_secrets(docs.limit(0)).count() == 0 and secrets.redacted(docs.limit(0)).count() == 0


def test_wrapped_glued_and_binary_base64():
    plain = "some words before the password=hunter2abcdefgh and some words behind it, so that lines break inside"
    hidden = lambda text: any(k == "assign" for _, _, k in spans(text))
    for width in (10, 64, 76):
        for end in ("\n", "\r\n", "\n    ", "\\n"):
            for data in (plain.encode(), gzip.compress(plain.encode() + bytes(range(256)))):
                for shift in range(3):
                    token = base64.b64encode(b"x" * shift + data if data[:1] != b"\x1f" else data).decode()
                    lines = [token[i : i + width] for i in range(0, len(token), width)]
                    text = "Body:\n\n" + end.join(lines) + "\n\nbye"
                    (low, high, _), *_ = [s for s in spans(text) if s[2] == "assign"]
                    assert text.index(lines[0]) <= low < high <= text.index("\n\nbye")
    # The place is that of the letters, across the line end.
    token = base64.b64encode(b"0123456789ab password=hunter2abc").decode()
    text = token[:24] + "\n" + token[24:]
    assert spans(text) == [(13 * 4 // 3, len(text) - 1, "assign")]
    # Tokens that hold the letters of paths themselves, behind prefixes of any length.
    slashed = base64.b64encode("\u00ff\u00bf? ~~~??? secret=abcdefghij ~~~???>>>".encode()).decode().rstrip("=")
    assert "/" in slashed and "+" in slashed
    for prefix in ("/path/", "key_", "a-b/cd_", "/p/"):
        for token in (slashed, slashed.replace("+", "-").replace("/", "_"), base64.b64encode(gzip.compress(b"secret=abcdefghij and so on")).decode()):
            text = f"see {prefix}{token} end"
            assert hidden(text) and all(4 + len(prefix) - 1 <= a < b <= len(text) - 4 for a, b, k in spans(text) if k == "assign")
    # One byte that is no UTF-8, and a key inside binary data, also compressed.
    for data in ("Stra\u00dfe token=abcdefgh".encode("latin-1"), bytes(range(128, 256)) + b" token=abcdefgh " + bytes(range(200))):
        for packed in (data, gzip.compress(data)):
            assert hidden(base64.b64encode(packed).decode())
    assert secrets.scan(base64.b64encode(bytes(range(128, 256))).decode())[1:] == ([], 0)


def test_all_members_and_large_pieces():
    import lzma

    key = b"now secret=abcdefghij comes"
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        token = base64.b64encode(pack(b"first member ") + pack(b"") + pack(key)).decode()
        assert {s[2] for s in spans(f"see {token}")} == {"assign"}
        # Beyond the limit, also across two chunks and in compressed data within.
        large = b"a b " * (1 << 18)
        for data in (large[:-12] + key + large, pack(large + key), pack(large) + pack(key)):
            token = base64.b64encode(pack(data)).decode()
            base, found, layers = secrets.scan(f"see {token}", limit=1000)
            assert "assign" in {k for _, _, k in found} and (4, 4 + len(token), "assign") in found and layers == 0
    two = [base64.b64encode(gzip.compress(b"x y " * 1000 + key + bytes([65 + i]))).decode() for i in range(2)]
    assert len(secrets.scan(" ".join(two), limit=1000)[1]) == 2


LAYERS = {
    "url": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
}


@pytest.mark.parametrize("seed", range(40))
def test_random_nests_are_found_where_they_lie(seed):
    """Up to four random layers around a text with or without a secret, between plain words: spans lie inside the nests that hold one, and nowhere else."""
    draw = random.Random(seed)
    out, at, wanted = [], 0, []
    for k in range(6):
        secret = draw.random() < 0.6
        core = f"password = hunter{draw.randrange(10**6, 10**7)}x" if secret else f"nothing {draw.randrange(1000)} to see here, only words"
        for layer in draw.choices(list(LAYERS), k=draw.randint(0, 4)):
            core = LAYERS[layer](core)
        for part, holds in ((f" word{k} and more\n", False), (core, secret)):
            if holds:
                wanted.append((at, at + len(part)))
            out.append(part)
            at += len(part)
    spans = secrets.scan("".join(out) + " end")[1]
    assert all(any(a <= start and end <= b for a, b in wanted) for start, end, *_ in spans)
    assert all(any(a <= start and end <= b for start, end, *_ in spans) for a, b in wanted)
