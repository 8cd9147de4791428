"""Column -> Column helpers, all of them JVM-side expressions."""

from sleeper.functions.ids import (  # noqa: F401
    ids_from_attribute_html,
    ids_from_links,
    links,
    safe_int,
)
from sleeper.functions.price import parse_price  # noqa: F401
from sleeper.functions.runs import iso_seconds, now_ntz, run_folder, run_ts_from_path  # noqa: F401
from sleeper.functions.scores import (  # noqa: F401
    obscurity_score,
    price_score,
    quality_score,
    tier,
    weighted_score,
)
from sleeper.functions.text import (  # noqa: F401
    equals_folded,
    is_target_label,
    join_list,
    normalize_text,
    pluck,
    slug,
    split_list,
    strip_edges,
)
