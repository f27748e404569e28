"""Names: one canonical name per player, and what the matches call them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rallybook.functions.columns import unused
from rallybook.functions.scalars import full_name, prefer_canonical
from rallybook.operators.joins import fits_broadcast, lookup_join
from rallybook.operators.sides import id_column, sides

# Partitions over which the matches of one player are spread when names are looked up in a
# players table too large to broadcast; each name is repeated as often.
NAME_SALTS = 16
# The same for the few matches that may need a correction, when the corrections are too many to broadcast.
CORRECTION_SALTS = 4
# The digest of the corrections: blocks of bits in words, which are broadcast; 16 MB at most.
WORD_BITS, BLOCK_WORDS = 64, 512
BITS_PER_CORRECTION, MOST_BLOCKS = 16, 1 << 12


def canonical_names(players: DataFrame) -> DataFrame:
    """One full name per id, the smallest where an id is listed under several."""
    known = players.where(F.col("player_id").isNotNull())
    return known.groupBy("player_id").agg(F.min("full_name").alias("full_name"))


def other_columns(side: str) -> list[str]:
    """Columns that tell the matches of one player apart."""
    return ["loser_id" if side == "winner" else "winner_id", "tourney_id", "round"]


def repair_names(matches: DataFrame, players: DataFrame) -> DataFrame:
    """Winner and loser names spelled as in the players table; unknown names stay unknown."""
    names, canonical = canonical_names(players), unused("_canonical", matches.columns)
    for side in ("winner", "loser"):
        lookup = names.select("player_id", F.col("full_name").alias(canonical))
        matches = lookup_join(
            matches, lookup, [f"{side}_id"], other_columns(side), salts=NAME_SALTS
        )
        fixed = prefer_canonical(F.col(f"{side}_name"), F.col(canonical))
        matches = matches.withColumn(f"{side}_name", fixed).drop(canonical)
    return matches


def name_corrections(matches: DataFrame, players: DataFrame) -> DataFrame:
    """The (id, name) pairs of the matches that differ from the players table, with the
    canonical name as `full_name`. Few as a rule, whatever the number of matches and players."""
    pairs = sides(matches).select("player_id", "name").distinct()
    lookup = canonical_names(players)
    pairs = lookup_join(pairs, lookup, ["player_id"], ["name"], salts=NAME_SALTS)
    return pairs.where(F.col("name") != F.col("full_name"))


def pair_bit(player_id: Column, name: Column, blocks: int) -> Column:
    """The bit of a pair in a digest of that many blocks."""
    return F.pmod(F.xxhash64(player_id, name), F.lit(blocks * BLOCK_WORDS * WORD_BITS))


def correction_digest(corrections: DataFrame) -> tuple[DataFrame, int]:
    """A bit set for every pair that needs a correction, as `digest_block` and `digest_words`, and the number of
    blocks. It is 16 bits for a correction, so one pair in 16 that needs none has its bit set too, or more
    where that would exceed `MOST_BLOCKS`."""
    wanted = corrections.count() * BITS_PER_CORRECTION // (BLOCK_WORDS * WORD_BITS)
    blocks = min(MOST_BLOCKS, 1 << wanted.bit_length())
    bit = pair_bit(F.col("player_id"), F.col("name"), blocks)
    rows = corrections.select(bit.alias("bit")).select(
        F.expr(f"bit div {WORD_BITS}").alias("word"),
        F.expr(f"shiftleft(1L, cast(bit % {WORD_BITS} as int))").alias("bits"),
    )
    empty = corrections.sparkSession.range(blocks * BLOCK_WORDS).select(F.col("id"), F.lit(0).cast("long"))
    words = rows.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = words.groupBy(F.expr(f"word div {BLOCK_WORDS}").alias("digest_block")).agg(
        F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("digest_words")
    )
    return words, blocks


def marked(matches: DataFrame, corrections: DataFrame, mark: str) -> DataFrame:
    """The matches with `mark`, false where neither name is corrected, found without a shuffle."""
    digest, blocks = correction_digest(corrections)
    found = F.lit(False)
    for side in ("winner", "loser"):
        block, words = (unused(f"_{side}_{part}", matches.columns) for part in ("block", "words"))
        player_id, name = F.col(f"{side}_id"), F.col(f"{side}_name")
        bit = pair_bit(player_id, name, blocks)
        known = F.when(player_id.isNotNull() & name.isNotNull(), F.floor(bit / (BLOCK_WORDS * WORD_BITS)))
        matches = matches.withColumn(block, known)
        parts = digest.select(F.col("digest_block").alias(f"{block}_"), F.col("digest_words").alias(words))
        matches = matches.join(F.broadcast(parts), F.col(block) == F.col(f"{block}_"), "left")
        word = F.floor(bit / WORD_BITS) % BLOCK_WORDS
        bits = F.get(F.col(words), word.cast("int"))
        is_set = F.call_function("getbit", bits, (bit % WORD_BITS).cast("int")) == 1
        found = found | F.coalesce(is_set, F.lit(False))
    helpers = [c for side in ("winner", "loser") for c in matches.columns if c.startswith((f"_{side}_block", f"_{side}_words"))]
    return matches.withColumn(mark, found).drop(*helpers)


def correct_names(matches: DataFrame, corrections: DataFrame) -> DataFrame:
    """What `repair_names` gives, by way of the corrections. Given a table of them that is small
    enough to broadcast, the matches are not shuffled, however many players there are. Otherwise a digest
    of them is broadcast, and only matches are shuffled that it does not rule out."""
    if fits_broadcast(corrections):
        return corrected(matches, corrections)
    mark = unused("_mark", matches.columns)
    rows = marked(matches, corrections, mark)
    right, open_rows = rows.where(~F.col(mark)).drop(mark), rows.where(F.col(mark)).drop(mark)
    return right.unionByName(corrected(open_rows, corrections))


def corrected(matches: DataFrame, corrections: DataFrame) -> DataFrame:
    """The matches joined to their corrections."""
    canonical = unused("_canonical", matches.columns)
    for side in ("winner", "loser"):
        lookup = corrections.select("player_id", "name", F.col("full_name").alias(canonical))
        keys = [f"{side}_id", f"{side}_name"]
        matches = lookup_join(matches, lookup, keys, other_columns(side), salts=CORRECTION_SALTS)
        fixed = F.coalesce(canonical, f"{side}_name")
        matches = matches.withColumn(f"{side}_name", fixed).drop(canonical)
    return matches


def distinct_names(matches: DataFrame) -> DataFrame:
    """The distinct (id, name) pairs of the winners and, marked by `won`, of the losers."""
    return sides(matches).select("won", "player_id", "name").distinct()


def name_candidates(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Every player with the distinct names its won and lost matches give it, respelled as
    its full name, without duplicate rows.

    After respelling a name can only be the full name or NULL. So what has to be known of
    the matches is whether either occurs, four flags per player, and the result is built from
    those instead of pairing all spellings of the wins with all those of the losses.
    """
    named, won = F.col("name").isNotNull(), F.col("won")
    flags = (
        sides(matches)
        .groupBy("player_id")
        .agg(
            F.bool_or(won & named).alias("_w_named"),
            F.bool_or(won & ~named).alias("_w_unnamed"),
            F.bool_or(~won & named).alias("_l_named"),
            F.bool_or(~won & ~named).alias("_l_unnamed"),
        )
    )

    def spellings(letter: str, player: str) -> Column:
        def spelling(name):
            return F.struct(
                F.col("player_id").alias(f"{player}_id"), name.alias(f"{player}_name")
            )

        options = F.array(
            F.when(F.col(f"_{letter}_named"), spelling(F.col("full_name"))),
            F.when(F.col(f"_{letter}_unnamed"), spelling(F.lit(None).cast("string"))),
        )
        return F.inline_outer(F.array_compact(options))

    rows = lookup_join(players, flags, ["player_id"], ["full_name"])
    columns = [F.col(c) for c in players.columns]
    rows = rows.select(*columns, "_l_named", "_l_unnamed", spellings("w", "winner"))
    rows = rows.select(*columns, "winner_id", "winner_name", spellings("l", "loser"))
    return rows.dropDuplicates()


def fill_names(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Missing first or last names taken from the smallest name the matches give the player.

    If the other half is known and the name starts or ends with it, the rest is the missing
    half; otherwise the name is cut at its first blank. A name without a blank fills nothing.
    """
    # Distinct pairs first: they are found by hashing, while the smallest of strings is found by
    # sorting, which should not be done to every match.
    named = sides(matches).select("player_id", "name").distinct()
    own_id, own_name = unused("_id", players.columns), unused("_name", players.columns)
    found = named.groupBy("player_id").agg(F.min("name").alias(own_name))
    rows = players.withColumn(own_id, id_column(players, "player_id"))
    rows = lookup_join(rows, found, [own_id], ["name_first", "name_last"])
    name, first, last = F.col(own_name), F.col("name_first"), F.col("name_last")
    cut = F.instr(name, " ")
    length = F.length(name)
    head = F.when(cut > 1, F.substring(name, F.lit(1), cut - 1))
    tail = F.when((cut > 1) & (cut < length), F.substring(name, cut + 1, length - cut))
    before_last = F.when(
        F.endswith(name, F.concat(F.lit(" "), last)) & (length > F.length(last) + 1),
        F.substring(name, F.lit(1), length - F.length(last) - 1),
    )
    after_first = F.when(
        F.startswith(name, F.concat(first, F.lit(" "))) & (length > F.length(first) + 1),
        F.substring(name, F.length(first) + 2, length),
    )
    return rows.withColumns(
        {
            "name_first": F.coalesce(first, before_last, head),
            "name_last": F.coalesce(last, after_first, tail),
        }
    ).drop(own_id, own_name)


def find_ids(players: DataFrame, *names: str) -> DataFrame:
    """Ids of the players with one of these full names, as a DataFrame."""
    return players.where(F.col("full_name").isin(*names)).select("player_id")


def with_full_name(players: DataFrame) -> DataFrame:
    return players.withColumn("full_name", full_name(F.col("name_first"), F.col("name_last")))


def repeated_ids(players: DataFrame) -> DataFrame:
    """Ids on more than one row and how many rows they have; empty for a clean table."""
    counts = players.groupBy("player_id").agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") > 1)


def assert_unique_ids(players: DataFrame) -> None:
    """Fails with some of the repeated ids if there are any."""
    repeated = repeated_ids(players).take(10)
    if repeated:
        raise ValueError(f"player_id is not unique, for example {repeated}")
