"""Rule-based quality filter with verdicts on whole hosts. DataFrame functions only.

Each text is judged by three rules: the base rule (too few words, too much
repeated), symbols against words, and repeated lines. Each rule's failures are
counted by host, a host's failure rate is shrunk towards all hosts' by a beta
prior fitted to the hosts' rates, and documents of hosts with a high shrunk rate
of any rule go with it. By itself only the base rule lets a document go.

Defined results: a NULL text counts as empty (0 words, fails); NULL is a host of
its own; repeated rows are each measured and counted; an empty table gives an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.text import bound, words_of
from curbside.operators.joins import lookup_join
from curbside.workspace import staged

# What the rules count and demand.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PERCENT = 30

# Symbols for a hundred words, and repeated for a hundred lines, above which a text
# counts against its host.
MAX_SYMBOLS_PERCENT = 10
MAX_DUP_LINES_PERCENT = 30

RULES = ("base_failed", "symbols_failed", "lines_failed")

# A host goes if more than this share of its documents is expected to fail one rule.
MAX_HOST_RATE = 0.5


def _pair_hashes(hashes: Column, step: int) -> Column:
    """Hash of elements i and i + step, for every i; the last ``step`` entries have no partner."""

    def paired(h: Column) -> Column:
        shifted = F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0)))
        return F.zip_with(h, shifted, lambda a, b: F.xxhash64(a, b))

    return bound(hashes, paired)


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash for every run of ``WINDOW_WORDS`` words, built by doubling."""
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    step = 1
    while step < WINDOW_WORDS:
        hashes = _pair_hashes(hashes, step)
        step *= 2
    whole = F.greatest(F.size(words) - (WINDOW_WORDS - 1), F.lit(0))
    return F.slice(hashes, 1, whole)


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at these ascending positions."""
    widths = F.transform(
        positions,
        lambda p, i: F.least(
            F.lit(WINDOW_WORDS), F.coalesce(F.get(positions, i + 1) - p, F.lit(WINDOW_WORDS))
        ),
    )
    return F.aggregate(widths, F.lit(0), lambda total, width: total + width)


def _repeated_words(hashes: Column) -> Column:
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(rows: Column) -> Column:
        same = lambda row, i: F.coalesce(F.get(rows, i)["h"] == row["h"], F.lit(False))
        twice = F.filter(rows, lambda row, i: same(row, i - 1) | same(row, i + 1))
        return F.sort_array(F.transform(twice, lambda row: row["i"]))

    counted = bound(ordered, lambda rows: bound(positions(rows), _covered))
    # Sorting is for texts with a repetition only; most have none.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(counted)


def _lines(text: Column) -> Column:
    """Lines with a word."""
    whole = F.coalesce(text, F.lit(""))
    return F.filter(F.split(whole, "\n"), lambda line: F.size(words_of(line)) > 0)


def measures(docs: DataFrame, text: str = "text") -> list[Column]:
    """The base measures of a text column, all exact."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = words_of(F.col(text))
    lines = _lines(F.col(text))
    bare = F.translate(whole, " \t\n\x0b\x0c\r", "")
    unmarked = F.translate(whole, SYMBOLS, "")
    return [
        F.size(words).cast("long").alias("n_words"),
        F.char_length(bare).cast("long").alias("word_chars"),
        (F.char_length(whole) - F.char_length(unmarked)).cast("long").alias("n_symbols"),
        bound(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))
        .cast("long")
        .alias("n_dup_lines"),
        bound(words, lambda w: bound(_window_hashes(w), _repeated_words))
        .cast("long")
        .alias("n_repeat_words"),
    ]


def host_rates(measured: DataFrame, rules: tuple[str, ...] = ("base_failed",)) -> DataFrame:
    """Rows (host, rule, n, failed, rate): failures per host and rule, shrunk by the rule's prior.

    The prior is a beta distribution whose mean is the rate over all documents
    and whose strength is matched to the spread of the hosts' rates, less what
    chance alone would spread hosts of their sizes. A spread that chance explains
    gives an endless strength (all hosts get the mean), and so do hosts of one
    document each; a spread as wide as 0 and 1 alone would give, no shrinking.
    """
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(rule).cast("long")).alias(rule) for rule in rules)
    )
    listed = F.array(*(F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("failed")) for rule in rules))
    hosts = hosts.select("host", "n", F.inline(listed))
    raw = F.col("failed") / F.col("n")
    prior = hosts.groupBy("rule").agg(
        (F.sum("failed") / F.sum("n")).alias("mean"),
        (F.avg(raw * raw) - F.avg(raw) * F.avg(raw)).alias("spread"),
        F.avg(1 / F.col("n")).alias("chance"),
    )
    # What two documents of a host have in common: 0 if hosts differ by chance alone.
    alike = F.try_divide(
        F.try_divide("spread", F.col("mean") * (1 - F.col("mean"))) - F.col("chance"), 1 - F.col("chance")
    )
    strength = F.when(alike > 1e-12, F.greatest(F.try_divide(F.lit(1.0), alike) - 1, F.lit(0.0)))
    prior = prior.select("rule", "mean", strength.alias("strength"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("strength")) / (
        F.col("n") + F.col("strength")
    )
    return (
        hosts.join(F.broadcast(prior), "rule")  # a row per rule
        .select("host", "rule", "n", "failed", F.coalesce(shrunk, F.col("mean")).alias("rate"))
    )


def host_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Rows (doc_id, measures…, base_failed, host_failed, kept), one per document.

    The texts are read once: their measures, a few numbers per document, are
    stored before hosts are counted.
    """
    measured = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).alias("host"),
        *measures(docs, text),
        F.size(_lines(F.col(text))).alias("n_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = measured.withColumns(
        {
            "base_failed": failed,
            "symbols_failed": 100 * F.col("n_symbols") > MAX_SYMBOLS_PERCENT * F.col("n_words"),
            "lines_failed": 100 * F.col("n_dup_lines") > MAX_DUP_LINES_PERCENT * F.col("n_lines"),
        }
    )
    measured = staged(judged.drop("n_lines"), "host-rules")
    verdicts = host_rates(measured, RULES).groupBy("host").agg(
        (F.max("rate") > max_host_rate).alias("host_failed")
    )
    judged = lookup_join(measured.drop(*RULES[1:]), verdicts, ["host"], null_safe=True)
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).drop("host")


SQL = r"""
with texts as (
  select doc_id, source, coalesce(text, '') as whole,
         [w for w in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] as words,
         row_number() over () as line
  from documents
),
windows as (
  select line, place,
         count(*) over (partition by line, array_to_string(words[place:place + 7], ' ')) as copies
  from (select line, words, unnest(range(1, len(words) - 6)) as place from texts where len(words) >= 8)
),
repeats as (
  select line, count(distinct place + step) as n
  from windows, range(8) as steps(step) where copies > 1 group by line
),
measured as (
  select doc_id, source, len(words)::bigint as n_words,
         length(regexp_replace(whole, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         (length(whole) - length(regexp_replace(whole, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(kept_lines) - len(list_distinct(kept_lines)))::bigint as n_dup_lines,
         coalesce(n, 0)::bigint as n_repeat_words, kept_lines
  from (select *, [l for l in string_split(whole, chr(10))
                    if regexp_matches(l, '[^\x20\x09-\x0D]')] as kept_lines from texts)
  left join repeats using (line)
),
judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
         100 * n_symbols > 10 * n_words as symbols_failed,
         100 * n_dup_lines > 30 * len(kept_lines) as lines_failed
  from measured
),
counted as (
  select source, count(*) as n, sum(base_failed::int) as base,
         sum(symbols_failed::int) as symbols, sum(lines_failed::int) as lines
  from judged group by source
),
hosts as (
  select source, n, 'base' as rule, base as f from counted
  union all select source, n, 'symbols', symbols from counted
  union all select source, n, 'lines', lines from counted
),
prior as (
  select rule, sum(f) / sum(n) as m, avg((f / n) * (f / n)) - avg(f / n) * avg(f / n) as v,
         avg(1 / n) as chance
  from hosts group by rule
),
strengths as (
  select rule, m, case when alike > 1e-12 then greatest(1 / alike - 1, 0) end as s
  from (select *, (v / nullif(m * (1 - m), 0) - chance) / nullif(1 - chance, 0) as alike from prior)
),
verdicts as (
  select source, max(coalesce((f + m * s) / (n + s), m)) > 0.5 as host_failed
  from hosts join strengths using (rule) group by source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       host_failed, not base_failed and not host_failed as kept
from judged join verdicts on judged.source is not distinct from verdicts.source
"""
