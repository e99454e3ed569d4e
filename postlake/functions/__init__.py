"""Column expressions."""

from postlake.functions.keys import company_key, company_name, posting_id, surrogate_key
from postlake.functions.numeric import (degrees_to_radians, haversine, safe_add, safe_divide,
                                        safe_subtract, width_bucket)
from postlake.functions.parsing import parse_experience, parse_salary, with_experience, with_salary
from postlake.functions.text import slugify, slugify_name
from postlake.functions.urls import (absolute_url, clean_url, company_from_url, url_host,
                                     url_parameter, url_path)

__all__ = [
    "company_key", "company_name", "posting_id", "surrogate_key", "degrees_to_radians", "haversine",
    "safe_add", "safe_divide", "safe_subtract", "width_bucket", "parse_experience", "parse_salary",
    "with_experience", "with_salary", "slugify", "slugify_name", "absolute_url", "clean_url",
    "company_from_url", "url_host", "url_parameter", "url_path",
]
