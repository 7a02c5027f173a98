"""Column-level helpers: pure ``pyspark.sql.functions`` expressions, so they
stay inside whole-stage codegen and push down where Catalyst allows."""

from churnkit.functions.dates import (  # noqa: F401
    epoch_ms_to_date, epoch_ms_to_timestamp, event_month, days_between,
)
from churnkit.functions.location import state_of, first_state, city_of  # noqa: F401
from churnkit.functions.columns import (  # noqa: F401
    sanitize_names, exact_length, is_churn_event, total_length,
)
