from tidewater.operators.audit import with_audit_columns  # noqa: F401
from tidewater.operators.dedup import latest_by_key  # noqa: F401
from tidewater.operators.hierarchy import flatten_parent  # noqa: F401
from tidewater.operators.keys import assign_sequential_key, current_lookup, version_spans  # noqa: F401
from tidewater.operators.members import with_unknown_member  # noqa: F401
from tidewater.operators.scd import scd2_apply, with_scd_columns  # noqa: F401
