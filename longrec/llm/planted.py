"""Labelled findings for the secret scanner: secrets and look-alikes planted into pieces of the corpus.

A table rarely says which of its findings are secrets.  Here a bounded number of documents lend a piece of text and a path each, and one
value is written into it.  What it is decides the label, whatever its form and place: credentials of several kinds,
named, in headers, addresses or prose; and what scanners take for them, as checksums, commits, ids, file names, versions, placeholders
and words behind a secret's name.  Many look alike and differ only in the words around them, and some names stand before both.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import text_or_empty
from longrec.llm.secret_scan import CorpusStatistics, findings

#: Documents that lend a piece, and characters of a piece on each side of the value.
MAX_ROWS, PIECE = 6_000, 150

NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access-key", "auth_token", "db_password", "client_secret")
SUMS = ("commit", "sha256", "md5", "etag", "checksum", "digest", "revision", "build", "fingerprint of the file is", "integrity hash")
IDS = ("request-id:", "trace", "order", "session number", "id =", "uuid", "ref.", "item", "node", "message-id:")
PLACEHOLDERS = (
    "changeme", "YOUR_TOKEN_HERE", "your-api-key", "xxxxxxxxxxxx", "${TOKEN}", "<password>", "example123", "********", "none", "null",
    "os.environ['KEY']", "insert_here", "placeholder", "TODO", "{{ secret }}", "test1234", "abc123", "required",
)
PROSE = ("the key is", "log in with", "credentials are", "use this to sign in:", "private key", "it answers to", "Bearer", "Authorization: Basic", "signed with", "x-api-key:")
SECRET_PATHS = ("deploy/prod.env", "conf/settings.yml", "infra/credentials.ini", "src/main.py", "notes/todo.txt")
PLAIN_PATHS = ("docs/readme.md", "tests/test_login.py", "examples/sample.env", "src/main.py", "dist/manifest.json")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SIGNS = _LETTERS + _LETTERS.upper() + "0123456789"


class Planter:
    """Random values and the text they stand in."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, choices):
        return choices[int(self.rng.integers(len(choices)))]

    def drawn(self, signs: str, least: int, most: int) -> str:
        return "".join(signs[i] for i in self.rng.integers(len(signs), size=int(self.rng.integers(least, most + 1))))

    def hex(self) -> str:
        return self.rng.bytes(int(self.pick((16, 20, 32)))).hex()

    def uuid(self) -> str:
        h = self.rng.bytes(16).hex()
        return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))

    def password(self) -> str:
        return self.drawn(_SIGNS + "!#$%*+-_.?", 8, 18)

    def credential(self) -> str:
        kinds = (
            self.hex, self.password, lambda: self.drawn(_SIGNS, 20, 44), lambda: base64.b64encode(self.rng.bytes(int(self.rng.integers(18, 40)))).decode(),
            lambda: self.pick(("AKIA", "ASIA")) + self.drawn(_SIGNS[26:52] + "0123456789", 16, 16), lambda: f"sk_live_{self.drawn(_SIGNS, 24, 24)}",
        )
        return self.pick(kinds)()

    def secret(self) -> tuple[str, str, str]:
        """(before, value, after) of a credential."""
        quote = self.pick(("", "", '"', "'"))
        named = f"{self.pick(NAMES)}{self.pick(('=', ' = ', ': ', ':'))}{quote}"
        forms: tuple[Callable, ...] = (
            lambda: (named, self.credential(), quote), lambda: (named, self.password(), quote),
            lambda: (f"{self.pick(PROSE)} ", self.credential(), ""),
            lambda: (f"{self.pick(('postgres', 'https', 'redis', 'amqp'))}://{self.drawn(_LETTERS, 3, 8)}:", self.password().replace("?", "x").replace("#", "y"), "@db.example.net/x"),
        )
        return self.pick(forms)()

    def harmless(self, words: list[str]) -> tuple[str, str, str]:
        """The same of something that only looks like one."""
        quote, word = self.pick(("", "", '"', "'")), self.pick(words)
        named = f"{self.pick(NAMES)}{self.pick(('=', ' = ', ': ', ':'))}{quote}"
        forms: tuple[Callable, ...] = (
            lambda: (named, self.pick(PLACEHOLDERS), quote), lambda: (named, word + self.pick(("", str(int(self.rng.integers(100))))), quote),
            lambda: (f"{self.pick(SUMS)} {quote}", self.hex(), quote), lambda: (f"{self.pick(IDS)} ", self.uuid(), ""),
            lambda: (f"{self.pick(IDS)} ", self.drawn("0123456789", 12, 20), ""), lambda: ("see ", f"{word}_{self.drawn('0123456789', 8, 10)}.jpg", ""),
            lambda: ("version ", f"{word}-{self.drawn('0123456789', 1, 2)}.{self.drawn('0123456789', 1, 2)}.{self.drawn('0123456789', 4, 8)}", ""),
            lambda: (f"{self.pick(SUMS)} {quote}", self.drawn(_SIGNS, 20, 44), quote), lambda: ("in ", f"/{word}/{self.pick(words)}/{word}_{self.pick(words)}", ""),
        )
        return self.pick(forms)()


def labelled_findings(
    docs: DataFrame, corpus: CorpusStatistics, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS, seed: int = 31
) -> DataFrame:
    """Findings (``secret_scan.findings``) in planted pieces, with ``label`` 1 or 0; their ids count from 0.

    ``max_rows`` documents lend a piece, those with the least hashes of their ids; other findings in a piece are left out.
    """
    spark, text = docs.sparkSession, text_or_empty(text_col)
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.greatest(F.length(text) - PIECE, F.lit(1))).cast("int") + 1
    order = F.xxhash64(F.col(id_col), F.octet_length(text))
    lent = docs.select(order.alias("order"), F.substring(text, place, F.lit(2 * PIECE)).alias("piece"))
    # so many rows pass that the least are among them, and no task sends many
    share = min(1.0, 4 * max_rows / max(docs.count(), 1))
    few = lent.where(F.col("order") <= int((share - 0.5) * (1 << 64)) - 1) if share < 1 else lent
    pieces = [r["piece"] for r in few.orderBy("order", "piece").limit(max_rows).collect()]
    if share < 1 and len(pieces) < max_rows:
        # ids that repeat: their hashes may leave a part of the range empty
        pieces = [r["piece"] for r in lent.orderBy("order", "piece").limit(max_rows).collect()]
    planter, rows = Planter(seed), []
    words = sorted({w for p in pieces for w in p.split() if w.isascii() and w.isalpha() and len(w) > 3}) or ["word"]
    for number, piece in enumerate(pieces):
        label = number % 2
        before, value, after = planter.secret() if label else planter.harmless(words)
        half = len(piece) // 2
        head = f"{piece[:half].rsplit(' ', 1)[0]} {before}"
        # one path in three tells nothing
        path = planter.pick(SECRET_PATHS if label == planter.pick((label, label, 1 - label)) else PLAIN_PATHS)
        rows.append((number, f"{head}{value}{after} {piece[half:]}", path, len(head), len(head) + len(value), label))
    planted = spark.createDataFrame(rows, "planted_id long, text string, path string, begin int, end int, label int")
    found = findings(planted, corpus, "planted_id", "text", "path")
    spots = planted.select(F.col("planted_id").alias("id"), "begin", "end", "label")
    same = (F.col("start") < F.col("end")) & (F.col("start") + F.col("length") > F.col("begin"))
    return found.join(F.broadcast(spots), "id").where(same).drop("begin", "end")
