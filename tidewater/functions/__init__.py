from tidewater.functions.cleanse import (  # noqa: F401
    EMAIL_PATTERN, MONEY, clean_email, title_case, upper_trim, money,
    line_total, discount_amount, line_profit, order_total, safe_pct, mask_email,
)
from tidewater.functions.dates import (  # noqa: F401
    date_key, iso_day_of_week, fiscal_year, fiscal_month, fiscal_quarter,
)
