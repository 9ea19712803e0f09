"""Secret scan: known forms by pattern, unknown ones by character Markov
models.  DataFrame operations only.

Two first-order Markov models over character classes, one of random strings
(keys, hashes, tokens) and one of ordinary identifiers and words, are trained
from labelled samples.  A candidate token whose mean log-likelihood ratio per
transition exceeds a threshold (higher for short tokens) is reported as ``markov`` unless it overlaps a
span that a pattern has found.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

#: The patterns of the base scan, in the order of the kinds.
ASSIGN = (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"           # maximal runs, so equal to runs of 16+ characters
KINDS = ("assign", "access", "hex", "markov")

#: Candidates of the models: tokens long enough to score, below LONG characters with a letter.
TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
#: Mean log-likelihood ratio per transition from which a token is reported; the
#: mean scatters more in short tokens, so each character under LONG raises it.
THRESHOLD = 0.2
SHORT_RISE = 0.025
LONG = 20
#: Added to every count of a transition.
SMOOTH = 0.05
#: Labelled random strings drawn for training.
N_RANDOM = 3_000

#: Labelled sample of ordinary identifiers and words.
ORDINARY = """
user_name first_name last_name created_at updated_at deleted_at is_active has_children parent_id order_id
customer_id invoice_number shipping_address billing_address email_address phone_number date_of_birth
getUserName setUserName toString parseInteger openConnection closeConnection readLine writeLine flushBuffer
handleRequest sendResponse createSession destroySession validateInput renderTemplate loadConfiguration
max_connections min_connections connection_timeout retry_count batch_size learning_rate hidden_size
num_layers vocab_size sequence_length attention_heads dropout_rate weight_decay warmup_steps checkpoint_path
HttpServletRequest HttpServletResponse AbstractFactoryBean ConcurrentHashMap LinkedBlockingQueue
test_user_login test_order_total test_empty_input assertEquals assertTrue beforeEach afterEach setUpClass
application/json text/html image/png multipart/form-data charset=utf-8 content-type content-length
src/main/java src/test/resources usr/local/bin etc/nginx/conf var/log/messages home/user/documents
the of and to in that is was he for it with as his on be at by this had not are but from or have an they which
one you were all her she there would their we him been has when who will no more if out so up said what its about
than into them can only other time new some could these two may first then do any like my now over such our man
me even most made after also did many off before must well back through years where much your way down should
because long each just state those people too mr how little good world make very year still see work own men day
get here old life both between being under three never know same last another while us might great go come since
against right came take used himself few house use during without again place american around however home small
found mrs thought went say part once general high upon school every dont does got united left number course war
until always away something fact water though less public put think almost hand enough took far head yet better
international understanding development organization administration responsibility characteristics environmental
der die das und ist nicht ein eine einen mit auf fuer von dem des sich auch wird werden haben sein nach bei
verantwortung gesellschaft wissenschaft entwicklung moeglichkeiten zusammenarbeit bundesrepublik wirtschaft
le la les des une est que qui dans pour pas sur avec sont plus tout etre fait comme mais ou leur deux meme
gouvernement developpement environnement international responsabilite particulierement administration
el los las una que por con para como mas pero sus este entre cuando muy sin sobre tambien hasta hay donde
desarrollo administracion responsabilidad conocimiento internacional universidad particularmente informacion
http www example com index html page search query utm_source feed article category product detail
version-1.2.3 release-2024 build-42 section-3 chapter-12 figure-7 table-4 page-21 item-8 step-1 node-16 port-8080
2023-01-15 2024-06-30 1999-12-31 2010-10-10 12345 100000 2000 1984 65536 3.14159 127.0.0.1 192.168.0.1
"""


def _class(c: Column) -> Column:
    """Index of an ASCII character: 0-25 a-z, 26-51 A-Z, 52-61 digits, 62 the rest."""
    a = F.ascii(c)
    return (F.when(a.between(97, 122), a - 97).when(a.between(65, 90), a - 39)
            .when(a.between(48, 57), a + 4).otherwise(F.lit(62)))


N_CLASSES = 63


def _transitions(samples: DataFrame) -> DataFrame:
    """(label, from, to, n) over samples (label, text)."""
    codes = F.transform(F.split("text", ""), lambda c: _class(c))
    pairs = let(codes, lambda s: F.transform(F.sequence(F.lit(0), F.size(s) - 2),
                                             lambda i: s[i] * N_CLASSES + s[i + 1]))
    return (samples.filter(F.length("text") > 1).select("label", F.explode(pairs).alias("pair"))
            .groupBy("label", "pair").agg(F.count("*").alias("n")))


def labelled_samples(spark: SparkSession) -> DataFrame:
    """(label, text): 0 ordinary (the list above), 1 random: strings of hex,
    upper-case base 32 and base 64 characters from digests of counters."""
    ordinary = spark.createDataFrame([(0, w) for w in ORDINARY.split()], "label int, text string")
    k = F.col("id").cast("string")
    b64 = F.translate(F.base64(F.unhex(F.sha2(k, 256))), "=", "")
    rand = spark.range(N_RANDOM).select(
        F.lit(1).alias("label"),
        F.when(F.col("id") % 6 == 0, F.sha1(k))
        .when(F.col("id") % 6 == 1, F.regexp_replace(F.upper(b64), "[^A-Z0-9]", "")).otherwise(b64).alias("text"))
    return ordinary.union(rand)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each transition, from
    (label, text) rows, with ``SMOOTH`` added to every count.  At most
    2 * 63 * 63 counts reach the driver, whatever the number of samples."""
    counts = {0: {}, 1: {}}
    for r in _transitions(samples).collect():
        counts[r.label][r.pair] = r.n
    logs = {}
    for label, c in counts.items():
        row = [sum(c.get(i * N_CLASSES + j, 0) + SMOOTH for j in range(N_CLASSES)) for i in range(N_CLASSES)]
        logs[label] = [math.log((c.get(p, 0) + SMOOTH) / row[p // N_CLASSES]) for p in range(N_CLASSES ** 2)]
    return [round(a - b, 6) for a, b in zip(logs[1], logs[0])]


def score(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of a token of two characters or more."""
    ratios = F.lit(model).cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: _class(c))
    return let(codes, lambda s: F.aggregate(
        F.sequence(F.lit(0), F.size(s) - 2), F.lit(0.0),
        lambda acc, i: acc + F.get(ratios, s[i] * N_CLASSES + s[i + 1])) / (F.size(s) - 1))


def _random(token: Column, model: list[float], threshold: float) -> Column:
    """Whether a token looks drawn at random.  A number below LONG characters
    does not count, and a token in capitals without a digit is scored in lower
    case: capitals alone say nothing."""
    length = F.length(token)
    capitals = (token == F.upper(token)) & ~F.regexp_like(token, F.lit("[0-9]"))
    limit = threshold + SHORT_RISE * F.greatest(F.lit(LONG) - length, F.lit(0))
    return (((length >= LONG) | F.regexp_like(token, F.lit("[A-Za-z]")))
            & (score(F.when(capitals, F.lower(token)).otherwise(token), model) > limit))


_SPANS = "array<struct<k:int,s:int,e:int,t:string>>"
#: Matches whose places are summed in one go.
PLACES = 256


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """array<struct<kind, start, end, found>> of the leftmost non-overlapping
    matches; starts and ends in code points, from the lengths of the pieces
    between the matches.

    Places are running sums over blocks of ``PLACES`` matches and then inside each
    block: a sum over all matches at once would copy the array once per match,
    which is quadratic in a long text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, f: F.struct(
        F.length(g).alias("gap"), F.length(f).alias("own"), f.alias("t")))

    def inside(block, first):
        """Spans of one block's pieces; the first piece begins at ``first``."""
        return F.aggregate(
            block, F.struct(first.alias("at"), F.array().cast(_SPANS).alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["own"]).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    F.lit(KINDS.index(kind)).alias("k"), (acc["at"] + x["gap"]).alias("s"),
                    (acc["at"] + x["gap"] + x["own"]).alias("e"), x["t"].alias("t")))).alias("out")),
            lambda acc: acc["out"])

    def place(p):
        blocks = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / PLACES).cast("int"))
        cut = F.transform(blocks, lambda b: F.slice(p, b * PLACES + 1, F.lit(PLACES)))

        def put(parts):
            long = F.transform(parts, lambda x: F.aggregate(x, F.lit(0), lambda acc, y: acc + y["gap"] + y["own"]))
            # where each block begins: one number a block
            starts = F.aggregate(long, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
            return let(starts, lambda at: F.flatten(F.transform(parts, lambda x, i: inside(x, at[i]))))
        return let(cut, put)

    return F.when(F.regexp_like(text, F.lit(pattern)), let(pieces, place)).otherwise(F.array().cast(_SPANS))


#: Characters of one piece of a mask.
MASK_PIECE = 512


def _mask(text: Column, pattern: str, counts) -> Column:
    """The text as pieces of ``MASK_PIECE`` characters, 1 inside the matches that
    ``counts`` accepts and 0 elsewhere; NULL without a match."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    bits = F.zip_with(gaps, found, lambda g, f: F.concat(
        F.repeat(F.lit("0"), F.length(g)), F.coalesce(F.repeat(F.when(counts(f), F.lit("1")).otherwise(F.lit("0")), F.length(f)), F.lit(""))))
    return F.when(F.regexp_like(text, F.lit(pattern)),
                  F.regexp_extract_all(F.array_join(bits, ""), F.lit(".{1,%d}" % MASK_PIECE), F.lit(0)))


def _covered(mask: Column, span: Column) -> Column:
    """Whether a span overlaps the mask: only the pieces that it touches are read."""
    first = F.floor(span["s"] / MASK_PIECE).cast("int")
    last = F.floor((span["e"] - 1) / MASK_PIECE).cast("int")
    near = F.array_join(F.slice(mask, first + 1, last - first + 1), "")
    own = F.substr(near, span["s"] - first * MASK_PIECE + 1, span["e"] - span["s"])
    return F.coalesce(F.contains(own, F.lit("1")), F.lit(False))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
         model: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``id``, ``found`` (array of kind, start, end in
    code points, end exclusive, by start and kind), ``base`` and ``spans``
    (the base spans and all spans as kind:start:end, comma-joined), ``n_assign``, ``n_access``,
    ``n_hex``, ``n_markov``.

    NULL and empty texts have no spans ('' and 0); a NULL id stays NULL;
    repeated rows are scanned each; texts are scanned whole; other columns
    are not read; an empty table gives no rows.
    """
    if model is None:
        model = train(labelled_samples(docs.sparkSession))
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    counts = {"assign": (ASSIGN, lambda f: F.length(F.regexp_extract(f, ASSIGN, 1)) >= 12),
              "access": (ACCESS, lambda f: F.length(f) >= 18), "hex": (HEX, lambda f: F.lit(True))}
    spans_of = lambda kind: F.filter(_spans(text, counts[kind][0], kind), lambda x: counts[kind][1](x["t"]))
    df = df.withColumns({**{kind: spans_of(kind) for kind in counts}, "tokens": _spans(text, TOKEN, "markov"),
                         **{f"{kind}_mask": _mask(text, *counts[kind]) for kind in counts}})
    df = df.select("id", F.concat("assign", "access", "hex").alias("known"),
                   F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"),
                   F.size("hex").cast("long").alias("n_hex"), "tokens", *[f"{kind}_mask" for kind in counts])
    known = F.col("known")
    extra = F.filter("tokens", lambda t: _random(t["t"], model, threshold)
                     & ~(_covered(F.col("assign_mask"), t) | _covered(F.col("access_mask"), t) | _covered(F.col("hex_mask"), t)))
    df = df.withColumn("markov", extra)
    every = F.concat("known", "markov")
    kinds = F.array(*map(F.lit, KINDS))
    return df.select("id", "n_assign", "n_access", "n_hex", F.size("markov").cast("long").alias("n_markov"),
                     F.transform(F.array_sort(F.transform(every, lambda x: F.struct(
                         x["s"].alias("start"), x["k"].alias("k"), x["e"].alias("end")))),
                         lambda x: F.struct(F.get(kinds, x["k"]).alias("kind"), x["start"], x["end"])).alias("found"),
                     _joined(known).alias("base"), _joined(every).alias("spans"))
