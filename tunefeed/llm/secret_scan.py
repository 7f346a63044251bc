"""Secret scan: candidate strings, and a random forest that removes false positives.

A candidate is a run of 16 or more of ``A-Z a-z 0-9 + / _ = -``, or what is assigned to a name
like those of secrets (``password = "..."``, ``api_key: ...``): 8 or more of any characters but white
space and quotation marks. Shorter strings are no candidates. The forest judges it by

* its length and kinds of characters,
* its character transitions (changes of kind; pairs that are common in words),
* how much of it words of a dictionary cover,
* the path it comes from, and
* the words before and after it.

It is trained from labelled findings (path, before, candidate, after, label). The default
``labelled_findings`` are made by rule from a seed: keys and tokens where they are assigned,
against checksums, identifiers, long words, numbers and placeholders. Any table of that
form can be given instead; a forest is a bounded model, and ``MOST`` labelled rows at most,
chosen by hash, are learned.

Everything runs as built-in expressions and the JVM's forest; there is no shuffle of texts.

Null text, or none long enough: no rows. Null path: an empty one. Null keys are kept.
Repeated texts and repeated candidates come back once per place. Candidates are whole,
however long. Empty table: no rows. Only the named columns are read.
"""

from __future__ import annotations

import json
import random
import string
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CHARS = "[A-Za-z0-9+/_=-]"
_NAMES = "token|secret|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential"
#: After an assignment (looked at first, as it is near), and that to such a name.
_ASSIGNED = "(?<=[=:]\\s{0,3}[\"'`]{0,1})"
_NAMED = f"(?<=(?i:{_NAMES})[\\w-]{{0,16}}[\"'`]{{0,1}}\\s{{0,3}}[=:]\\s{{0,3}}[\"'`]{{0,1}})"
#: An assigned value, or a whole run of candidate characters.
CANDIDATE = f"{_ASSIGNED}{_NAMED}[^\\s\"'`]{{8,}}+|(?<!{_CHARS}){_CHARS}{{16,}}+"
#: Labelled rows that the forest learns from, about.
MOST = 50_000
#: Characters before and after a candidate that hold its neighbouring words.
NEAR = 48

#: Words that long names are often made of (several languages and code).
DICTIONARY = """
the and ing tion ment that with for from this have which there their about would when what your
can will more other some time into only new also after first over such these than most could
und der die das nicht ein ich mit auf ist den von zu für les des que est dans pour sur avec une
los las por con para como pero este name user file path test data value list table index type
class object string number array config default example error message request response server
client http https www html json xml css get set add new key code line text page view image
version license public private static final return import package module function method
""".split()

_COMMON_PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|ch|de|ri|ro|ic|ne|ra|li|ll|ei|ie|un|sc|qu|ai|eu"
_SECRET_WORDS = "token|secret|passw|pwd|api.?key|apikey|access.?key|private.?key|auth|bearer|credential|session"
_PLAIN_WORDS = "commit|sha-?\\d|sha\\b|md5|checksum|integrity|digest|hash|etag|revision|uuid|guid|build|href|src|url|class|file|path|version|example|sample"
_PATHS = {
    "path_lock": r"(?i)lock|\.sum$|checksum|manifest",
    "path_test": r"(?i)test|spec|fixture|example|sample|mock",
    "path_text": r"(?i)\.(md|rst|txt|html?|tex)$|docs?/|readme|changelog",
    "path_config": r"(?i)\.(env|ini|ya?ml|toml|properties|conf|cfg|json)$|config|secret",
}


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def features(found: DataFrame) -> DataFrame:
    """``found`` (path, before, secret, after) with one double column per feature."""
    secret, lower = F.col("secret"), F.lower("secret")
    before, after = F.lower("before"), F.lower("after")
    seen = [F.when(F.instr(lower, c) > 0, 1).otherwise(0) for c in string.ascii_lowercase + string.digits]
    covered = F.length(lower) - F.length(F.regexp_replace(lower, "|".join(sorted(set(DICTIONARY), key=lambda w: (-len(w), w))), ""))
    made = {
        "length": F.least(F.length(secret), F.lit(400)),
        "digits": _share(secret, "[0-9]"),
        "capitals": _share(secret, "[A-Z]"),
        "signs": _share(secret, "[+/_=-]"),
        "marks": _share(secret, "[^A-Za-z0-9+/_=-]"),
        "brackets": _share(secret, r"[(){}<>\[\].,;:]"),
        "hex": _share(secret, "[0-9a-fA-F]"),
        "distinct": reduce(Column.__add__, seen) / F.least(F.length(secret), F.lit(36)),
        "digit_turns": _share(secret, "[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"),
        "case_turns": _share(secret, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "repeats": _share(secret, r"(.)(?=\1)"),
        "common_pairs": _share(lower, f"(?={_COMMON_PAIRS})"),
        "covered": covered / F.greatest(F.length(lower), F.lit(1)),
        "parts": F.regexp_count(secret, F.lit("[A-Za-z]{3,}[/_-]|[/_-][A-Za-z]{3,}")),
        "assigned": before.rlike("[=:]\\s*[\"'`]?$"),
        "quoted": before.rlike("[\"'`]$") & after.rlike("^[\"'`]"),
        "secret_before": before.rlike(_SECRET_WORDS),
        "secret_last": before.rlike(f"({_SECRET_WORDS})[\\w-]*[\"'`]?\\s*[=:]?\\s*[\"'`]?$"),
        "plain_before": before.rlike(f"({_PLAIN_WORDS})\\W*$"),
        "plain_after": after.rlike(f"^\\W*({_PLAIN_WORDS})|^\\.[a-z]{{2,4}}\\b|^@"),
        **{name: F.coalesce(F.col("path"), F.lit("")).rlike(pattern) for name, pattern in _PATHS.items()},
    }
    return found.select("*", *(F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{name}") for name, c in made.items()))


FEATURES = [
    *(f"f_{n}" for n in ("length", "digits", "capitals", "signs", "marks", "brackets", "hex", "distinct", "digit_turns", "case_turns", "repeats")),
    *(f"f_{n}" for n in ("common_pairs", "covered", "parts", "assigned", "quoted", "secret_before", "secret_last")),
    *(f"f_{n}" for n in ("plain_before", "plain_after", *_PATHS)),
]


def labelled_findings(spark: SparkSession, rows: int = 1600, seed: int = 7) -> DataFrame:
    """path, before, secret, after, label: findings made by rule, half of them secrets."""
    rng = random.Random(seed)
    pick, hexes, base = rng.choice, "0123456789abcdef", string.ascii_letters + string.digits

    def drawn(chars: str, n: int) -> str:
        return "".join(rng.choice(chars) for _ in range(n))

    def word() -> str:
        return "".join(pick(["ing", "tion", "er", "the", "an", "ou", "re", "st", "ver", "schau", "ment", "eau", "rr", "que", "os", "lich", "on", "he"]) for _ in range(rng.randint(5, 9)))

    secrets = [
        lambda: drawn(hexes, pick([32, 40, 64])),
        lambda: drawn(hexes, pick([32, 40])).upper(),
        lambda: "AKIA" + drawn(string.ascii_uppercase + string.digits, 16),
        lambda: "ghp_" + drawn(base, 36),
        lambda: "sk_live_" + drawn(base, 24),
        lambda: drawn(base + "+/", pick([40, 43, 64])),
        lambda: drawn(base + "_-", pick([20, 24, 32])),
        lambda: drawn(base + "$!@#%^&*?-_", rng.randint(10, 24)),
        lambda: word()[: rng.randint(4, 8)].title() + pick("!@#$%&*-_") + drawn(string.digits, rng.randint(3, 5)) + pick(["", "!", "#", "x"]),
        lambda: ".".join(drawn(base + "_-", n) for n in (20, 40, 43)),
    ]
    owners = ["token", "secret", "api_key", "apiKey", "password", "access_key", "auth_token", "client_secret", "aws_secret_access_key", "TOKEN", "SECRET_KEY", "Authorization: Bearer", "private key"]
    plains = [
        lambda: ("", word(), " "),
        lambda: ("", word().upper(), pick(["!! ", "### ", " "])),
        lambda: (pick(["id ", "no. ", "", "+"]), drawn(string.digits, rng.randint(16, 30)), " "),
        lambda: (pick(["commit ", "sha256:", "md5 = ", "integrity=\"", "etag: \"", "checksum: ", "revision "]), drawn(hexes, pick([32, 40, 64])), pick(["", '"', " is"])),
        lambda: ("uuid: ", "-".join(drawn(hexes, n) for n in (8, 4, 4, 4, 12)), "\n"),
        lambda: (pick(["src=\"", "href=/", "import ", "file "]), "/".join(pick(DICTIONARY) for _ in range(5)) + "/index", pick([".html", ".js", " "])),
        lambda: ("class ", "".join(pick(DICTIONARY).title() for _ in range(5)), " {"),
        lambda: (pick(["def ", "", "x = "]), "_".join(pick(DICTIONARY) for _ in range(5)), "("),
        lambda: (pick(["", "\n"]), pick("-=_x0") * rng.randint(16, 60), "\n"),
        lambda: (pick(owners) + " = \"", pick(["your_api_key_goes_here", "xxxxxxxxxxxxxxxxxxxxxxxx", "changeme_changeme_1", "REPLACE_WITH_YOUR_TOKEN", "example-secret-value", "0000000000000000000000"]), '"'),
        lambda: (
            pick(owners) + pick([" = ", ": ", "=", ': "']),
            pick([
                word(), word().title() + pick([".", ","]), pick(DICTIONARY) + "." + pick(["password", "token", "getSecret()", "value,"]), "required", "disabled", "undefined",
                "get" + pick(owners).replace(" ", "") + "()", "os.environ[KEY]", "process.env.TOKEN", "${SECRET_KEY}", "<your-token>", "********", "changeme", "$(cat/run/key)",
                "function(" + pick(DICTIONARY) + ")", "https://" + pick(DICTIONARY) + ".example.com/login", "self._" + pick(DICTIONARY) + ",", "{{" + pick(DICTIONARY) + "_token}}",
            ]),
            pick([" ", "\n", '"']),
        ),
        lambda: ("mail ", word() + str(rng.randint(10, 99)), "@mail.example.com"),
        lambda: ("data:image/png;base64,", drawn(base, 60), '"'),
    ]
    paths = ["src/app.py", "src3", "config/prod.env", "settings.yml", "README.md", "tests/test_auth.py", "package-lock.json", "", "deploy.sh", "docs/index.html"]
    out = []
    for i in range(rows):
        lead = " ".join(word()[: rng.randint(2, 9)] for _ in range(3)) + pick([" ", ". ", "\n"])
        if i % 2:
            mark = pick([(' = "', '"'), ("='", "'"), (": ", "\n"), (" ", " "), ('": "', '",'), (" = ", "\n")])
            out.append({"path": pick(paths), "before": lead + pick(owners) + mark[0], "secret": pick(secrets)(), "after": mark[1] + " " + word(), "label": 1.0})
        else:
            before, plain, after = pick(plains)()
            assigned = before.rstrip(" \"")[-1:] in ("=", ":") and any(o in before for o in owners)
            if len(plain) >= (8 if assigned else 16):
                out.append({"path": pick(paths), "before": lead + before, "secret": plain, "after": after + word(), "label": 0.0})
    schema = "array<struct<path:string,before:string,secret:string,after:string,label:double>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(out)), schema)))


def train_forest(labelled: DataFrame, *, trees: int = 40, depth: int = 8, seed: int = 11) -> PipelineModel:
    """A forest of labelled findings (path, before, secret, after, label)."""
    rows = labelled.filter("secret IS NOT NULL AND label IS NOT NULL")
    share = MOST / max(rows.count(), 1)
    if share < 1:
        draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "path", "before", "secret", "after"), 11) / float(1 << 53)
        rows = rows.filter(draw < share)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return Pipeline(stages=[assembler, forest]).fit(features(rows).coalesce(1))


def candidates(df: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """key, path, nth (from 1 in its text), before, secret, after of every candidate."""
    held = df.select(F.col(key).alias("key"), F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    held = held.withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).filter(F.size("found") > 0)
    # What stands between candidates: one piece more than there are candidates.
    held = held.withColumn("between", F.split("text", CANDIDATE, -1))
    tail, head = (lambda c: F.substring(c, -NEAR, NEAR)), (lambda c: F.substring(c, 1, NEAR))
    near = F.transform(
        F.sequence(F.lit(0), F.size("found") - 1),
        lambda i: F.struct(
            (i + 1).cast("long").alias("nth"),
            tail(F.concat(F.coalesce(tail(F.get("found", i - 1)), F.lit("")), F.get("between", i))).alias("before"),
            F.get("found", i).alias("secret"),
            head(F.concat(F.get("between", i + 1), F.coalesce(head(F.get("found", i + 1)), F.lit("")))).alias("after"),
        ),
    )
    return held.select("key", "path", F.explode(near).alias("c")).select("key", "path", "c.*")


def scan(df: DataFrame, model: PipelineModel | None = None, *, key: str = "doc_id", text: str = "text", path: str = "source", least: float = 0.5) -> DataFrame:
    """key, nth, secret, probability of the candidates that the forest keeps."""
    model = model or train_forest(labelled_findings(df.sparkSession))
    judged = model.transform(features(candidates(df, key=key, text=text, path=path)))
    kept = judged.withColumn("p", vector_to_array("probability")[1]).filter(F.col("p") >= least)
    return kept.select(F.col("key").alias(key), "nth", "secret", F.col("p").alias("probability"))
