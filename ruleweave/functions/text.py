"""Text expressions: URL cleaning, missing values, prompts, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ruleweave.defaults import JUDGE_WORDS, NEGATIVE_TOKEN, POSITIVE_TOKEN, SEED, SYSTEM_PROMPT
from ruleweave.functions.draws import draw

# What counts as a URL, and the parts that are kept of it.
URL_PATTERN = r'https?://[^\s<>"{}|\\^`\[\]]+'
NETLOC_PATTERN = r"^https?://([^/?#]*)"
PATH_PATTERN = r"^https?://[^/?#]*([^?#]*)"
PARAMS_PATTERN = r";[^/]*$"

# Characters whose compatibility form holds one of / ? # @ : and which a standard URL parser
# therefore refuses in a host name.
REFUSED_HOST_PATTERN = (
    "[⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫"
    "＃／：？＠]"
)

# The cell contents that a CSV reader with default settings takes as missing.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _url_tag(url: Column) -> Column:
    netloc = F.regexp_extract(url, NETLOC_PATTERN, 1)
    domain = F.replace(F.lower(netloc), F.lit("www."), F.lit(""))
    path = F.regexp_replace(F.regexp_extract(url, PATH_PATTERN, 1), PARAMS_PATTERN, "")
    parts = F.slice(F.filter(F.split(path, "/", -1), lambda p: p != ""), 1, 2)
    kept = F.concat_ws("/", F.array(domain), parts)
    return F.when(netloc.rlike(REFUSED_HOST_PATTERN), F.lit("<url>: (unknown)")).otherwise(
        F.concat(F.lit("<url>: ("), kept, F.lit(")"))
    )


def clean_urls(text: Column | str) -> Column:
    """Replace every URL by ``<url>: (domain/p1/p2)``; text without a URL and nulls pass through."""
    text = _col(text)
    between = F.split(text, URL_PATTERN, -1)
    tags = F.transform(F.regexp_extract_all(text, F.lit(URL_PATTERN), F.lit(0)), _url_tag)
    # One more gap than URLs, so the last pair has no tag.
    pieces = F.zip_with(between, tags, lambda gap, tag: F.concat(gap, F.coalesce(tag, F.lit(""))))
    # The substring test keeps the regular expressions off the many texts without a URL.
    return F.when(text.contains("://"), F.array_join(pieces, "")).otherwise(text)


def str_or_nan(value: Column | str) -> Column:
    """The value as text; missing becomes the text ``nan``."""
    return F.coalesce(_col(value).cast("string"), F.lit("nan"))


def normalize_missing(text: Column | str) -> Column:
    """Null for the cell contents that stand for a missing value."""
    text = _col(text)
    return F.when(~text.isin(*MISSING_TOKENS), text)


def digest(text: Column | str) -> Column:
    """Fixed-width join key of a text. Null stays null.

    Joins and distincts on long texts shuffle this key instead of the text itself.
    """
    return F.sha2(_col(text).cast("binary"), 256)


def build_prompt(
    subreddit: Column | str = "subreddit",
    rule: Column | str = "rule",
    positive_example: Column | str = "positive_example",
    negative_example: Column | str = "negative_example",
    body: Column | str = "body",
    *,
    system_prompt: str = SYSTEM_PROMPT,
    judge_words: str = JUDGE_WORDS,
) -> Column:
    """Few-shot prompt text. The worked answers are always Yes and No, whatever the answer tokens are."""
    return F.concat(
        F.lit(f"{system_prompt}\nSubreddit: r/"),
        str_or_nan(subreddit),
        F.lit("\nRule: "),
        str_or_nan(rule),
        F.lit("\nExamples:\n1) "),
        str_or_nan(positive_example),
        F.lit(f"\n{judge_words} Yes\n2) "),
        str_or_nan(negative_example),
        F.lit(f"\n{judge_words} No\nComment: "),
        str_or_nan(body),
        F.lit(f"\n{judge_words}"),
    )


def label_to_token(
    label: Column | str, *, positive_token: str = POSITIVE_TOKEN, negative_token: str = NEGATIVE_TOKEN
) -> Column:
    """1 and 0 become the answer tokens, anything else is missing."""
    label = _col(label)
    return F.when(label == 1, F.lit(positive_token)).when(label == 0, F.lit(negative_token))


def pick_example(
    first: Column | str, second: Column | str, tag: str, *keys: Column | str, seed: int = SEED
) -> Column:
    """Fair coin per row between two columns."""
    return F.when(draw(tag, *keys, seed=seed) % 2 == 0, _col(first)).otherwise(_col(second))


def sft_text(prompt: Column | str = "prompt", completion: Column | str = "completion") -> Column:
    """Prompt followed by its answer, as one training text."""
    return F.concat(_col(prompt), _col(completion))


def strip_prompt(full: Column | str, prompt: Column | str) -> Column:
    """What follows the prompt in a generated text."""
    full, prompt = _col(full), _col(prompt)
    return F.substring(full, F.length(prompt) + 1, F.length(full))


def reply_to_label(reply: Column | str, *, positive_token: str = POSITIVE_TOKEN) -> Column:
    """True where the reply is the positive token exactly; a missing reply is false."""
    return F.coalesce(_col(reply) == F.lit(positive_token), F.lit(False))
