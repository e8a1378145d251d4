"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are runs of key characters with a digit, long runs of capitals and digits, and whatever is
assigned to a name that sounds like a secret: a quoted value whole, else the run up to a space, of any
characters from four on. For each, the
forest sees its length, the changes between character classes, how much of it common words cover,
whether it is part of a path, address or mail, and the words beside it. It is trained by Spark's
random forest on labelled findings, then written as one column expression, so a scan is one
projection over the documents: no shuffle, no Python, a document's candidates stay in its row.

Null and empty texts have no candidates. Texts are scanned whole; what a row costs follows its own
length. Repeated rows and null ids are judged row by row; all columns are carried, whatever their
names. An empty table gives no rows. Findings of one class only can train no forest and are refused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.llm.common import as_rows, staged

_KEY = r"A-Za-z0-9_+/\-"
_LINK = r"(?:=>|:=|[=:])[ \t]{0,3}(?i:(?:bearer|basic) )?"
_NAME = r"(?i:pass|pwd|secret|token|api.?key|credential|auth(?!or(?!i))|access.?key|private)[\w\-]{0,16}"
# The one character first: it spares most places the longer looks back.
_ASSIGNED = rf"(?<=[=:> \t\"'])(?<={_LINK}[\"']?)(?<={_NAME}[\"']?[ \t]{{0,3}}{_LINK}[\"']?)"
# Punctuation that ends a run is not part of it, nor are the next parameter of an address and a tag. All
# loops are possessive: the JVM's engine runs those in place, others take a stack frame per character.
_MARK = r"[.,;:)\]}]"
_SIGN = r"&(?![\w.\-]++=)|<(?![/A-Za-z])"
_PLAIN = r"[^\s\"'&<.,;:)\]}]"
_RUN = (
    rf"(?=(?:{_PLAIN}|{_MARK}|{_SIGN}){{3}}{_MARK}*+(?:{_PLAIN}|{_SIGN}))"
    rf"(?:{_PLAIN}++|{_SIGN}|{_MARK}++(?={_PLAIN}|{_SIGN}))++"
)
_VALUE = rf"(?:(?<=\")[^\"\r\n]{{4,}}+(?=\")|(?<=')[^'\r\n]{{4,}}+(?=')|{_RUN})"
CANDIDATE = rf"{_ASSIGNED}{_VALUE}|(?<![{_KEY}])(?:(?=[A-Za-z_+/\-]*+[0-9])[{_KEY}]{{12,}}+|[A-Z0-9]{{16,}}+)"
CONTEXT = 40
REDACTED = "[REDACTED]"

# Labelled findings that ``example_findings`` makes, and the forest's size.
EXAMPLES = 6_000
TREES = 15
DEPTH = 5

# Words that occur in identifiers, paths and prose.
COMMON = (
    "about account address admin after agent all and api app archive array asset author auto back base batch beta "
    "block body book build button cache call card case change chapter check class client code column com commit "
    "common config content control copy core count create current data date day debug default delete demo detail "
    "dev device dir doc document domain down download edit email end error event example export field file filter "
    "final first folder font form format from function global group header home host html http icon image img "
    "import index info input item java job json key label lang last layout level lib library line link list load "
    "local log login main map master menu message meta method mobile model module month name net new news node "
    "note null number object office online open option order org output package page part path photo plan plugin "
    "point post print private product profile project public query read record release report request resource "
    "result road root sample search section server service session set setting shop show site size source spec "
    "src start state static status step store string style sub support system table tag target task team temp test "
    "text the theme time title tool total track type update upload url use user util value version video view web "
    "week width window with work www year zone"
).split()

# Words of sentences and of code that no one takes into a secret.
PROSE = (
    r"(?i)\b(?:a|an|the|your|you|to|is|are|was|for|of|in|on|or|and|not|no|be|must|please|enter|here|with|this|that|it|"
    r"required|invalid|missing|none|null|true|false|string|str|text|int|bool|undefined|optional|forgot|forgotten)\b"
)

FEATURES = (
    "length digits changes hex vowels covered slashes in_path in_mail secret_word hash_word known_start distinct "
    "only_digits assigned upper spaces marks prose reference quoted"
).split()


def features(token: Column, before: Column, after: Column) -> Column:
    """What the forest sees of a candidate, as a struct of doubles."""
    length = F.length(token).cast("double")
    share = lambda pattern: F.regexp_count(token, F.lit(pattern)) / length
    flag = lambda value: F.coalesce(value.cast("double"), F.lit(0.0))
    words = "|".join(sorted(COMMON, key=len, reverse=True))
    left = F.length(F.regexp_replace(F.lower(token), words, "")) / length
    change = "(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z0-9])(?=[_+/-])"
    values = {
        "length": length,
        "digits": share("[0-9]"),
        "changes": share(change),
        "hex": flag(token.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "vowels": share("(?i)[bcdfghjklmnpqrstvwxyz][aeiou]"),
        "covered": 1 - left,
        "slashes": F.regexp_count(token, F.lit("/")).cast("double"),
        "in_path": flag(before.rlike(r"(?:://\S*|[/\\.])$") | after.rlike(r"^(?:/|\\|\.[a-z]{2,4}\b)")),
        "in_mail": flag(after.rlike(r"^[\w.]*@") | before.rlike("@$")),
        "secret_word": flag(before.rlike(r"(?i)(?:pass|pwd|secret|token|api.?key|credential|auth|access.?key|private)\S*\W{0,4}\S{0,8}$")),
        "hash_word": flag(before.rlike(r"(?i)(?:sha.?\d*|md5|commit|hash|digest|uuid|checksum|etag|revision|build|order|invoice|id)\W{1,4}$")),
        "known_start": flag(token.rlike(r"^(?:AKIA|ASIA|AIza|ghp_|gho_|sk-|sk_live|xox[bpa]-|eyJ|glpat-)")),
        "distinct": F.size(F.array_distinct(F.split(token, ""))) / length,
        "only_digits": flag(token.rlike(r"^[0-9+\-]+$")),
        "assigned": flag(before.rlike(r"[=:]\s{0,2}[\"']?$")),
        "upper": share("[A-Z]"),
        "spaces": F.regexp_count(token, F.lit(" ")).cast("double"),
        "marks": F.regexp_count(token, F.lit(r"[^\w+/\- ]")).cast("double"),
        "prose": F.regexp_count(token, F.lit(PROSE)).cast("double"),
        "reference": flag(token.rlike(r"^[$%{<*\[]|^https?:|\w\(|\w\[|^[A-Za-z_]\w*+(?:\.[A-Za-z_]\w*+)++$|(?i)your|example|^x+$")),
        "quoted": flag(before.rlike("[\"']$")),
    }
    return F.struct(*(values[name].alias(name) for name in FEATURES))


def example_findings(spark: SparkSession, rows: int = EXAMPLES, seed: str = "findings") -> DataFrame:
    """Labelled findings (before, token, after, label) of common shapes, the same on every run."""
    numbered = spark.range(rows).select(
        "id",
        F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).alias("h"),
        F.base64(F.unhex(F.sha2(F.concat(F.lit(seed + "b"), F.col("id").cast("string")), 512))).alias("b"),
    )
    h, b = F.col("h"), F.regexp_replace("b", "[^A-Za-z0-9]", "")
    pick = lambda options, at: F.element_at(F.array(*map(F.lit, options)), (F.conv(F.substring("h", at, 4), 16, 10).cast("int") % len(options)) + 1)
    prose = pick(["then the ", "we saw ", "and set ", "in it ", "Le mot ", "und der ", "para los ", ""], 1)
    words = F.concat_ws("", pick(COMMON, 5), pick(COMMON, 9), pick(COMMON, 13))
    syllables = ["sch", "er", "ber", "tz", "tion", "an", "the", "ing", "ou", "ll", "ez", "que", "ment", "ier", "on", "nd", "re", "ge"]
    spoken = F.concat(*(pick(syllables, at) for at in (33, 37, 41, 45, 49, 53, 57)))
    invented = [F.concat(*(pick(syllables, at + i) for at in (33, 45))) for i in range(4)]
    secret = lambda name: F.concat(prose, F.lit(name))
    name = pick(["password", "PASSWORD", "passwd", "secret", "api_key", "apikey", "auth_token", "token", "client_secret", "access_key"], 17)
    link = pick(["=", " = ", ": ", ' = "', '="', "='", ": '"], 21)
    upper, digits = F.upper(b), F.substring(F.conv(F.substring("h", 9, 8), 16, 10), 1, 4)
    shapes = [
        (F.concat(prose, F.lit("key ")), F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), F.lit(" then"), 1),
        (prose, F.concat(F.lit("AKIA"), F.substring(upper, 3, 16)), F.lit(" of it"), 1),
        (F.concat(prose, name, link), F.substring(h, 1, 40), F.lit('" and'), 1),
        (F.concat(prose, name, link), F.substring(h, 3, 18), F.lit(" in"), 1),
        (F.concat(prose, name, link), F.substring(b, 1, 24), F.lit("\n"), 1),
        (prose, F.concat(F.lit("ghp_"), F.substring(b, 2, 36)), F.lit("."), 1),
        (secret("bearer "), F.concat(F.lit("sk-"), F.substring(b, 4, 40)), F.lit(" "), 1),
        (F.concat(prose, name, link), F.substring(b, 5, 16), F.lit("'"), 1),
        (F.concat(prose, pick(["commit ", "sha1: ", "sha256 ", "md5=", "hash ", "checksum: ", "etag "], 25)), F.substring(h, 1, 40), F.lit(" was"), 0),
        (F.concat(prose, pick(["id ", "uuid: ", "order ", "build ", "revision "], 25)), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 12)), F.lit(","), 0),
        (F.concat(prose, F.lit("see https://example.org/")), F.concat(words, F.lit("/"), F.substring(h, 1, 6)), F.lit(".html"), 0),
        (prose, F.concat(words, F.substring(F.conv(F.substring("h", 1, 8), 16, 10), 1, 3)), F.lit(" is"), 0),
        (prose, F.substring(F.conv(F.substring("h", 1, 15), 16, 10), 1, 16), F.lit(" then"), 0),
        (F.concat(prose, F.lit("mail ")), F.concat(words, F.substring(h, 1, 2), F.lit("1")), F.lit("@example.com"), 0),
        (F.concat(prose, name, link), F.concat(words, F.lit("_EXAMPLE_1")), F.lit(" or"), 0),
        (prose, F.upper(F.concat(words, words)), F.lit("!!"), 0),
        (prose, F.upper(spoken), F.lit("!!"), 0),
        (F.concat(prose, F.lit("die ")), F.concat(spoken, F.substring(F.conv(F.substring("h", 1, 8), 16, 10), 1, 2)), F.lit(","), 0),
        (F.concat(prose, F.lit("src/")), F.concat(pick(COMMON, 29), F.lit("/"), words, F.lit("_"), F.substring(h, 1, 3), F.lit("2")), F.lit(".py"), 0),
        (F.concat(prose, name, link), F.concat(F.initcap(pick(COMMON, 5)), digits, pick(["!", "#", "?", "$1", "@", ""], 21)), F.lit(" then"), 1),
        (F.concat(prose, name, link), F.concat(F.translate(F.initcap(pick(COMMON, 9)), "eoais", "30415"), pick(["!", "#", "$", "%"], 13), pick(COMMON, 29), pick(["#", "!", "*"], 33), F.substring(digits, 1, 1)), F.lit(" in"), 1),
        (F.concat(prose, name, link), F.substring(F.regexp_replace("b", "[^A-Za-z]", ""), 1, 20), F.lit("\n"), 1),
        (F.concat(prose, name, link), F.substring(F.regexp_replace("b", "[^A-Za-z]", ""), 3, 16), F.lit(" and"), 1),
        (F.concat(prose, name, link), F.substring(b, 7, 9), F.lit(" "), 1),
        (F.concat(prose, name, pick(['="', ' = "', ': "'], 21)), F.concat_ws(" ", *(pick(COMMON, at) for at in (5, 9, 13, 29))), F.lit('" and'), 1),
        (F.concat(prose, name, pick(['="', ' = "', ': "'], 21)), F.concat_ws(" ", *invented), F.lit('" and'), 1),
        (F.concat(prose, name, link), F.concat_ws("-", *(pick(COMMON, at) for at in (5, 9, 13, 29))), F.lit(" and"), 1),
        (F.concat(prose, name, link), F.concat_ws("-", *invented), F.lit(" and"), 1),
        (F.concat(prose, name, pick([": ", "=", " = "], 21)), pick(COMMON, 5), F.lit(" for"), 0),
        (F.concat(prose, name, pick([": ", "=", " = "], 21)), pick(["required", "None", "null", "string", "undefined", "missing", "invalid", "true", "optional", "forgotten"], 5), F.lit(" for"), 0),
        (F.concat(prose, name, F.lit(": ")), spoken, F.lit(" and"), 0),
        (F.concat(prose, name, link), F.concat(pick(COMMON, 5), F.lit("."), pick(COMMON, 9), pick(["", "()", '("x")'], 13)), F.lit(" in"), 0),
        (F.concat(prose, name, link), F.concat(pick(["$", "${", "%(", "{{"], 5), F.upper(pick(COMMON, 9)), F.lit("_"), F.upper(pick(COMMON, 13))), F.lit("\n"), 0),
        (F.concat(prose, name, link), pick(["********", "xxxxxxxx", "your_password", "your-api-key", "YOUR_TOKEN_HERE", "example"], 5), F.lit("\n"), 0),
        (F.concat(prose, name, pick(['="', ' = "', ': "'], 21)), F.concat_ws(" ", pick(["Please enter the", "Enter your", "The", "This is the", "You must set a"], 5), pick(COMMON, 9), pick(["for the", "of this", "is not in the", "or the"], 13), pick(COMMON, 29)), F.lit('",'), 0),
    ]
    kind = F.col("id") % len(shapes)
    made = F.when(F.lit(False), F.struct(F.lit("").alias("before"), F.lit("").alias("token"), F.lit("").alias("after"), F.lit(0).alias("label")))
    for i, (before, token, after, label) in enumerate(shapes):
        one = F.struct(before.alias("before"), token.alias("token"), after.alias("after"), F.lit(label).alias("label"))
        made = made.when(kind == i, one)
    return staged(numbered.select(made.alias("f")).select("f.*"), "examples")


@dataclass(frozen=True)
class Forest:
    """The trees as nested (feature, threshold, left, right) or a vote, and the accuracy on held-out findings."""

    trees: tuple
    accuracy: float

    def score(self, seen: Column) -> Column:
        """The share of trees that call a candidate a secret."""

        def branch(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(seen[FEATURES[feature]] <= threshold, branch(left)).otherwise(branch(right))

        votes = [branch(tree) for tree in self.trees]
        total = votes[0]
        for vote in votes[1:]:
            total = total + vote
        return total / float(len(votes))


def _trees(model: RandomForestClassificationModel) -> tuple:
    def walk(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return float(node.prediction())
        split = node.split()
        return (split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild()))

    return tuple(walk(tree._java_obj.rootNode()) for tree in model.trees)


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """A forest from labelled findings; a fifth of them, chosen by hash, is held out for its accuracy."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    seen = findings.where("label IS NOT NULL AND token <> ''").select(
        features(F.col("token"), text("before"), text("after")).alias("f"),
        F.col("label").cast("double").alias("label"),
        (F.pmod(F.xxhash64("token", "before"), F.lit(5)) == 0).alias("held"),
    )
    measured = staged(seen.select("f.*", "label", "held"), "findings")
    ready = VectorAssembler(inputCols=FEATURES, outputCol="seen").transform(measured)
    classes = {r.label for r in ready.where("NOT held").select("label").distinct().collect()}
    if classes != {0.0, 1.0}:
        raise ValueError(f"findings of both classes are needed, found {sorted(classes)}")
    forest = RandomForestClassifier(featuresCol="seen", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=32, seed=11)
    model = forest.fit(ready.where("NOT held"))
    right = model.transform(ready.where("held")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    return Forest(_trees(model), right if right is not None else float("nan"))


def scan(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """``row`` (all columns) and ``found``: token, before, after, score, secret of every candidate; ``redacted``."""
    text = F.col("row.text").cast("string")
    tokens = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    split = as_rows(docs).select("row", F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    pieces = F.when(F.size("tokens") > 0, F.split(text, CANDIDATE, -1))
    beside = split.select("row", "tokens", pieces.alias("pieces"))

    def candidate(token: Column, i: Column) -> Column:
        before, after = F.right(F.get("pieces", i), F.lit(CONTEXT)), F.left(F.get("pieces", i + 1), F.lit(CONTEXT))
        return F.struct(token.alias("token"), before.alias("before"), after.alias("after"), features(token, before, after).alias("seen"))

    def judged(c: Column) -> Column:
        return F.struct(c["token"].alias("token"), c["before"].alias("before"), c["after"].alias("after"), forest.score(c["seen"]).alias("score"))

    none = F.array().cast("array<struct<token:string,before:string,after:string,score:double>>")
    found = F.when(F.size("tokens") > 0, F.transform(F.transform("tokens", candidate), judged)).otherwise(none)
    scored = beside.select("row", "pieces", found.alias("found"))
    clean = F.transform("found", lambda c: F.when(c["score"] > threshold, F.lit(REDACTED)).otherwise(c["token"]))
    put = F.concat(
        F.get("pieces", F.lit(0)),
        F.array_join(F.zip_with(clean, F.slice("pieces", F.lit(2), F.size("found")), lambda c, p: F.concat(c, p)), ""),
    )
    secrets = F.filter("found", lambda c: c["score"] > threshold)
    return scored.select(
        "row", "found", secrets.alias("secrets"), F.when(F.size(secrets) > 0, put).otherwise(text).alias("redacted")
    )


def redact(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """The documents with every secret replaced; all others keep their text untouched."""
    scanned = scan(docs, forest, threshold)
    own: Callable[[str], Column] = lambda c: F.col("redacted").alias(c) if c == "text" else F.col("row").getField(c).alias(c)
    return scanned.select(*(own(c) for c in docs.columns))


def through_scan(findings: DataFrame, forest: Forest, threshold: float = 0.5) -> tuple[float, float]:
    """Of labelled findings written out as texts: the share of secrets redacted whole, and of others touched."""
    texts = findings.select("token", "label", F.concat("before", "token", "after").alias("text"))
    scanned = scan(texts, forest, threshold)
    whole = F.exists("secrets", lambda s: s["token"] == F.col("row.token"))
    of = lambda label, hit: F.avg(F.when(F.col("row.label") == label, hit.cast("double")))
    return tuple(scanned.agg(of(1, whole), of(0, F.size("secrets") > 0)).first())
