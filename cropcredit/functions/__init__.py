from cropcredit.functions.columns import (  # noqa: F401
    clean_text,
    crop_year,
    crop_year_label,
    infer_type,
    month_delta,
    safe_date,
    safe_double,
    strftime_to_java,
    typed_column,
)
