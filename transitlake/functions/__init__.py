"""Column functions. All of them are built from Spark expressions and stay inside code generation."""

from transitlake.functions.codec import (  # noqa: F401
    base64url_decode,
    base64url_encode,
    feed_key,
    feed_key_url,
    feed_url,
)
from transitlake.functions.display import (  # noqa: F401
    compact_bytes,
    compact_number,
    feed_type_label,
    feed_type_rank,
    month_day,
)
from transitlake.functions.hashing import in_shard, md5_mod, start_offset  # noqa: F401
from transitlake.functions.naming import feed_id, feed_name  # noqa: F401
from transitlake.functions.paths import (  # noqa: F401
    base64url_segment,
    compacted_path_parts,
    path_stem,
    raw_path,
    schedule_path_parts,
)
from transitlake.functions.times import (  # noqa: F401
    iso_timestamp,
    previous_day,
    seconds_between,
    seconds_since,
    utc_date,
    utc_hour,
    utc_iso,
    utc_stamp,
)
