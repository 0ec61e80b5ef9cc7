"""From titled comments to scored rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from voxseries import constants as K
from voxseries.operators.lexicon import lexicon_score, with_lexicon_score
from voxseries.operators.target import targeted_comments
from voxseries.sources.tables import write_table

TEXT = "targeted_sentence"
COPIES = "copies"


def series_rows(
    joined: DataFrame,
    lexicon: DataFrame,
    add_class: Callable[[DataFrame, str], DataFrame],
    dictionary=K.GROUP_KEYWORDS,
    zone: str = "UTC",
) -> DataFrame:
    """What a rollup needs of each (comment, group named in it), in one pass over the input:
    group, date, week, class and lexicon score, with equal rows folded into ``copies``.

    ``add_class`` takes the rows and the name of the text column and adds ``trans_sentiment``.
    Only the text and the narrow columns reach the scorers, and no text is shuffled.
    """
    narrow = ["party", "date", "week"]
    rows = targeted_comments(joined, dictionary, zone).select(*narrow, TEXT)
    keep = [*narrow, "trans_sentiment"]
    return lexicon_score(add_class(rows, TEXT), TEXT, lexicon, keep, copies_col=COPIES)


def run_scoring(
    joined: DataFrame,
    lexicon: DataFrame,
    add_class: Callable[[DataFrame, str], DataFrame],
    out: str,
    dictionary=K.GROUP_KEYWORDS,
    zone: str = "UTC",
) -> DataFrame:
    """Full scored rows, text included, stored under ``out``. The classified rows are stored
    first, because the lexicon scores are joined back to them."""
    rows = targeted_comments(joined, dictionary, zone).drop("full_text")
    stored = write_table(add_class(rows, TEXT), f"{out}/classified")
    return write_table(with_lexicon_score(stored, TEXT, lexicon), f"{out}/scored")
