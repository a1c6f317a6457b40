"""Secrets by pattern, and by novelty: strings that a primed compressor cannot shorten.

The novelty of a candidate is what it adds to the compressed size of the text around it, by a zstandard compressor
primed with a dictionary of code words and identifiers, divided by its own bytes. Words, paths and strings like those
nearby cost little; random material costs about its full entropy. Other copies of the candidate itself are taken out of
the text around it first, so a secret that is written several times is reported at every place. Candidates are long strings
with letters and digits that start at most ``REACH`` characters after a sensitive word, or end as closely before one.
Those at or above ``NOVELTY`` are reported as kind
``novel`` unless a pattern already covers them.

Positions are code points, the end is exclusive. Null and empty texts have no spans, an empty table gives no rows, and
very long texts are read once, with a bounded piece around each candidate. Repeated rows each get a result; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.llm.tables import SPANS, span_array

KINDS = ("assign", "access", "hex", "novel")
#: Added bytes per byte of the candidate; random base64 costs 0.8 to 1.1, names 0.3 to 0.7.
NOVELTY = 0.75
AROUND = 512
REACH = 48

# Words that announce a secret.
SENSITIVE = ("password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "credential", "private_key", "access_key", "auth", "bearer")
# What code and configuration around a secret usually says.
CODE_WORDS = (
    "import from return def class function const let var public private static final void string int bool true false null none "
    "self this new await async export default require include struct impl use package namespace try except catch raise throw "
    "config settings environment env getenv os.environ process.env application properties yaml json toml ini key value name "
    "user username password passwd passphrase secret token access_token refresh_token api_key apikey client_id client_secret "
    "authorization bearer basic header headers request response http https localhost host port database url uri path file "
    "license version author description example test sample dummy placeholder changeme your_api_key_here xxxxxxxxxxxxxxxx "
    "AccessToken RefreshToken TokenProvider SecretManager PasswordEncoder KeyStore CredentialsProvider ServiceClient ControllerImpl "
    "FactoryImpl RequestHandler ResponseBuilder SessionContext ConfigurationProperties AuthenticationManager UserRepository TestCase "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 1234567890abcdef"
)

_ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_LEAST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{_LEAST},}}")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[str, int, int]


def patterns(text: str, low: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each pattern that are long enough, by start, then kind."""
    found: list[Span] = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@cache
def _compressor() -> zstandard.ZstdCompressor:
    primer = zstandard.ZstdCompressionDict(CODE_WORDS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=primer, write_checksum=False, write_content_size=False)


def novelty(candidate: str, around: str) -> float:
    """Compressed bytes the candidate adds to its surroundings, per byte of the candidate."""
    size = len(candidate.encode())
    if not size:
        return 0.0
    pack = _compressor().compress
    before = around.encode()
    return max(0, len(pack(before + b"\n" + candidate.encode())) - len(pack(before))) / size


def surroundings(text: str, a: int, b: int) -> str:
    """Up to ``AROUND`` characters on both sides of a candidate, without its other copies or cut-off parts of them."""
    s, n = text[a:b], b - a
    low, high = max(0, a - AROUND), min(len(text), b + AROUND)
    cut = text.find(s, max(0, low - n + 1), min(a, low + n - 1))
    low = cut + n if 0 <= cut < low else low
    cut = text.rfind(s, max(b, high - n + 1), high + n - 1)
    high = cut if 0 <= cut < high < cut + n else high
    return (text[low:a] + "\n" + text[b:high]).replace(s, " ")


def novel(text: str, low: str, base: list[Span]) -> list[Span]:
    """Incompressible strings in a sensitive context that no base span overlaps."""
    if not any(w in low for w in SENSITIVE):
        return []
    found: list[Span] = []
    done = 0

    def judge(a: int, b: int) -> None:
        s = text[a:b]
        if not any(c.isdigit() for c in s) or not any(c.isalpha() for c in s) or any(x < b and a < y for _, x, y in base):
            return
        if novelty(s, surroundings(text, a, b)) >= NOVELTY:
            found.append(("novel", a, b))

    runs = [m.span() for m in _CANDIDATE.finditer(text)]
    first = 0  # of the runs that may stand before this word or a later one
    for word in _SENSITIVE.finditer(text):
        while first < len(runs) and runs[first][1] <= word.start():
            a, b = runs[first]
            if a >= done and word.start() - b <= REACH:
                done = b
                judge(a, b)
            first += 1
        last = word.end() + REACH + _LEAST
        for m in _CANDIDATE.finditer(text, max(done, word.end()), min(len(text), last)):
            a, b = m.span()
            if b == last:  # the string may run on
                b = _CANDIDATE.match(text, a).end()
            done = b
            judge(a, b)
    return found


def spans_of(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans by start, then kind, each with whether it is a base span."""
    if not text:
        return []
    low = text.lower()
    base = patterns(text, low)
    more = novel(text, low, base)
    every = [(*s, True) for s in base] + [(*s, False) for s in more]
    return sorted(every, key=lambda s: (s[1], KINDS.index(s[0]))) if more else every




@F.arrow_udf(SPANS)
def secret_spans(texts: pa.Array) -> pa.Array:
    return span_array(texts, spans_of)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans`` (kind, start, end, base) of every row."""
    return docs.select(id_col, secret_spans(F.col(text_col)).alias("spans"))
