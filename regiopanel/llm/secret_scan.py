"""Secret scan with a random forest that removes false findings.

Candidates are found by several patterns: what a credential's name is assigned (from four characters on, of
any characters), the password of a URL, what follows ``Bearer``, known formats of keys, and long runs of token
characters that hold a letter or digit.  The name and its sign of assignment stand before a value, never in
it.  A value's length, character transitions, coverage by a dictionary, the document's path and the words beside it are
features of a random forest, trained on a bounded sample of labelled findings.

Defined results: a null or empty text has no candidate; repeated rows get equal results; an empty table
or one without candidates gives an empty result; where the labelled findings are all of one class,
every candidate gets that class; a null path is an empty one.  Only the named columns are read,
so others can't clash.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import columns, let, text_or_empty
from regiopanel.session import stored

# Characters of a long run, and of an assigned value.
LEAST, LEAST_ASSIGNED = 16, 4
# Character of a name, and what names of credentials hold.
OF_NAME = r"[\p{L}\p{N}_.-]"
NAMED = (
    r"(?i:(?<!mon|don|tur|hoc|joc|whis)key(?!word|board|note|stone|frame)|token(?!i[sz])|secret(?!ar)|passw|passphrase"
    r"|passcode|(?<!com|by|tres|sur|over|under)passe?(?!\p{L})|pwd|auth(?!or(?!i[sz]))|bearer|cred(?:ential|s?(?!\p{L}))"
    r"|contrase[nñ]a|kennwort)"
)
QUOTE = "[\"'`]"
# From a name's end to its value: brackets of the name, a type, the sign, a scheme, and an opening quote.
SIGN = (
    r"[\"'`\])]{0,3}+[\x20\t]*+(?::[\x20\t]*+[A-Za-z_][\w.<>\[\]|]*+[\x20\t]++=(?![=>])|=>|[=:]{1,3}+)[\x20\t]*+"
    rf"(?:(?i:bearer|basic|digest|token)[\x20\t]++)?+(?:[bfruBFRU]{{1,2}}(?={QUOTE}))?+{QUOTE}?+"
)
# Ends a value without quotes: closing marks before a blank, a closed quote, or the next name.
STOP = rf"[\"'`;,)\]}}>.]{{0,8}}+(?:\s|\z)|{QUOTE}[,;:)\]}}]|[;&,][\w.-]{{1,40}}+="
VALUE = (
    "(?:" + "|".join(rf"(?<={q})(?:[^{q}\\\n]|\\.){{{LEAST_ASSIGNED},}}+(?={q})" for q in "\"'`")
    + rf"|(?!{QUOTE})(?:(?!{STOP})\S){{{LEAST_ASSIGNED},}}+)"
)
NAME = rf"(?<!{OF_NAME})(?={OF_NAME}++[\"'`\])]{{0,3}}+[\x20\t]*+[=:]){OF_NAME}*?{NAMED}{OF_NAME}*+{SIGN}(?={VALUE})"
PASSWORD = r"[^\s/\"'<>]+(?=@)"
BEARER = r"[\w.~+/=-]{8,}+"
FORMAT = (
    r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}+(?![0-9A-Z])|gh[pousr]_[A-Za-z0-9]{16,}+|github_pat_\w{20,}+|glpat-[\w-]{16,}+"
    r"|xox[abeoprs]-[A-Za-z0-9-]{10,}+|[prsw]k_(?:live|test)_[A-Za-z0-9]{10,}+|sk-[\w-]{16,}+|AIza[\w-]{35}+"
    r"|SG\.[\w-]{16,}+\.[\w-]{16,}+|(?:npm|hf)_[A-Za-z0-9]{20,}+|eyJ[\w-]{6,}+\.[\w-]{2,}+(?:\.[\w-]++){0,3}+"
    r"|-----BEGIN\x20[A-Z0-9\x20]*PRIVATE\x20KEY-----[^-]*+(?:-(?!----(?:END|BEGIN))[^-]*+)*+"
    r"-----END\x20[A-Z0-9\x20]*PRIVATE\x20KEY-----)"
)
# A run that starts where none did before, up to its padding or to a credential's name that is assigned in it.
RUN = (
    rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{{{LEAST}}})(?=[+/_-]*+[A-Za-z0-9])"
    rf"(?:[A-Za-z0-9_-]|[+/](?!{NAME})){{{LEAST},}}+(?:={{1,2}}+(?![A-Za-z0-9+/_=-]))?+"
)
# Group 1 is what stands before the value, group 5 the value; the empty groups in the first tell which values
# may follow. What comes first only spares the search within words.
PATTERN = (
    r"(?=://|(?<![A-Za-z0-9])[\p{L}\p{N}_.:+/-])"
    rf"((?:{NAME}()|://[^\s/:@\"']*+:(?={PASSWORD})()|(?<!\w)(?i:bearer)\x20++(?={BEARER})())?+)"
    rf"(\2{VALUE}|\3{PASSWORD}|\4{BEARER}|(?<![A-Za-z0-9]){FORMAT}|{RUN})"
)
# Marks around values; a text's own ones become another control character, which matches the same.
OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"
BESIDE = 32
# Bound of the labelled findings that the forest is trained on.
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 6, 17
# Words of which credentials seldom consist, and words that stand before them (fixed values).
DICTIONARY = (
    "the and for that with this from example sample test dummy license version public document index page "
    "password token secret value name file user data image chapter section report"
).split()
CUES = r"(?i)(key|token|secret|passw|pwd|auth|bearer|credential|apikey)"
ASSIGNED = rf"{NAMED}{OF_NAME}*+{SIGN}$"
SIGN_BEFORE = r"[=:]>?[\x20\t\"'`]*$"
# Assigned, but no secret: references, calls, blanks to fill in, and literals.
PLACEHOLDER = (
    r"(?i)^(?:\$[{(].*|(?-i:\$[A-Z_]+)|%s|%\(.*|<.*|\{\{.*|\*+|x+|[a-z_.]+[(\[].*|(?:process\.env|os\.environ).*"
    r"|your[_-].*|change_?me|placeholder.*|redacted.*"
    r"|true|false|null|none|nil|undefined|string|optional|required)$"
)


def _places(text: Column) -> Column:
    """Array of (start, end, value, before, after) of the candidates."""

    def placed(pieces: Column) -> Column:
        """Every second piece is a value, the others lie between."""
        none = F.array().cast("array<struct<start:int,end:int,value:string>>")
        first = F.struct(F.lit(0).alias("at"), none.alias("out"))

        def step(acc: Column, k: Column) -> Column:
            start = acc["at"] + F.length(F.get(pieces, 2 * k))
            end = start + F.length(F.get(pieces, 2 * k + 1))
            value = F.substring(text, start + 1, end - start)
            one = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        order = F.sequence(F.lit(0), F.floor(F.size(pieces) / 2).cast("int") - 1)
        return F.when(F.size(pieces) > 1, F.aggregate(order, first, step, lambda acc: acc["out"])).otherwise(none)

    def beside(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - BESIDE, F.lit(0)) + 1, F.least(s["start"], F.lit(BESIDE)))
        after = F.substring(text, s["end"] + 1, F.lit(BESIDE))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            before.alias("before"), after.alias("after"),
        )

    own = F.replace(F.replace(text, F.lit(OPEN), F.lit(OTHER)), F.lit(CLOSE), F.lit(OTHER))
    marked = F.regexp_replace(own, F.lit(PATTERN), F.lit(f"$1{OPEN}$5{CLOSE}"))
    return F.transform(let(F.split(marked, f"[{OPEN}{CLOSE}]", -1), placed), beside)


def candidates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """One row per candidate: doc_id, path, start, end, value, before, after."""
    rows = columns(docs, doc_id=id_col, text=text_col, path=path_col)
    rows = rows.select("doc_id", F.coalesce("path", F.lit("")).alias("path"), _places(text_or_empty("text")).alias("c"))
    return rows.select("doc_id", "path", F.explode("c").alias("c")).select("doc_id", "path", "c.*")


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def _formatted() -> Column:
    return F.col("value").rlike(f"^{FORMAT}$")


def _in_url() -> Column:
    return F.col("before").rlike(r"(?:://|^)[^\s/:@]*:$") & F.col("after").startswith("@")


def features() -> dict[str, Column]:
    """By name, over the columns of candidates."""
    return {
        "length": F.length("value").cast("double"),
        "digits": _share(F.col("value"), "[0-9]"),
        "capitals": _share(F.col("value"), "[A-Z]"),
        "hexadecimal": _share(F.col("value"), "[0-9A-Fa-f]"),
        "signs": _share(F.col("value"), "[+/=_-]"),
        "other signs": _share(F.col("value"), "[^A-Za-z0-9+/=_-]"),
        "known format": _formatted().cast("double"),
        "in a URL": _in_url().cast("double"),
        "placeholder": F.col("value").rlike(PLACEHOLDER).cast("double"),
        "letter to digit": _share(F.col("value"), "[A-Za-z](?=[0-9])"),
        "digit to letter": _share(F.col("value"), "[0-9](?=[A-Za-z])"),
        "digit to digit": _share(F.col("value"), "[0-9](?=[0-9])"),
        "vowel and consonant": _share(F.col("value"), "(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"),
        "distinct characters": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "dictionary": 1 - F.length(F.regexp_replace("value", f"(?i){'|'.join(DICTIONARY)}", "")) / F.length("value"),
        "path of tests": F.col("path").rlike("(?i)test|example|sample|doc|mock").cast("double"),
        "path depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "cue before": F.col("before").rlike(CUES).cast("double"),
        "assigned": F.col("before").rlike(SIGN_BEFORE).cast("double"),
        "quoted": (F.col("before").rlike(f"{QUOTE}$") & F.col("after").rlike(f"^{QUOTE}")).cast("double"),
        "cue after": F.col("after").rlike(CUES).cast("double"),
    }


def labels(found: DataFrame) -> DataFrame:
    """Findings whose class is certain: of a known format, or assigned to a credential's name or in a URL and of
    mixed characters; or placeholders, and numbers and words that nothing assigns. The others have no label."""
    mixed = F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")
    assigned = F.col("before").rlike(ASSIGNED) | _in_url()
    neutral = ~F.col("before").rlike(CUES) & ~F.col("before").rlike(SIGN_BEFORE) & ~assigned
    label = F.when(F.col("value").rlike(PLACEHOLDER), 0.0).when(_formatted() | (assigned & mixed), 1.0)
    return found.withColumn("label", label.when(neutral & ~mixed, 0.0)).filter("label is not null")


def sample(labelled: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The same findings whatever the partitions, one of each value with what stands before it, half of
    them at most of one class."""
    first = F.min(F.struct("doc_id", "start", "path", "end", "after")).alias("first")
    distinct = labelled.groupBy("label", "value", "before").agg(first).select("label", "value", "before", "first.*")
    at = F.xxhash64("value", "before")
    classes = [distinct.filter(F.col("label") == x).orderBy(at, "value", "before").limit(size // 2) for x in (0.0, 1.0)]
    return classes[0].unionByName(classes[1])


def scan(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """The candidates with p_secret and is_secret, from a forest trained on labelled ones."""
    names = [f"f{i}" for i in range(len(features()))]
    chosen = [value.alias(name) for name, value in zip(names, features().values(), strict=True)]
    assemble = VectorAssembler(inputCols=names, outputCol="features")
    train = stored(sample(labelled).select("label", "doc_id", "start", *chosen), "labelled")
    classes = {r.label for r in train.select("label").distinct().collect()}
    if len(classes) < 2:
        only = classes.pop() if classes else 0.0
        return found.withColumn("p_secret", F.lit(only)).withColumn("is_secret", F.lit(only > 0.5))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    # One partition in a fixed order, of a bounded sample: trees don't depend on how rows were dealt.
    model = forest.fit(assemble.transform(train.coalesce(1).sortWithinPartitions("doc_id", "start")))
    scored = model.transform(assemble.transform(found.select("*", *chosen)))
    p = vector_to_array("probability")[1]
    kept = [c for c in found.columns]
    return scored.select(*kept, p.alias("p_secret"), (p >= 0.5).alias("is_secret"))
