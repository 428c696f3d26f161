"""Column -> Column expressions; all built-in Spark functions (codegen, no UDF)."""

from icdspark.functions.text import (  # noqa: F401
    clean_note,
    join_tokens,
    join_vector,
    split_on_space,
    split_whitespace,
    token_count,
    tokenize,
    text_length,
)
from icdspark.functions.codes import (  # noqa: F401
    dot_diagnosis,
    dot_procedure,
    reformat_code,
    strip_leading_zeros,
)
from icdspark.functions.arrays import (  # noqa: F401
    multi_hot,
    l2_normalize,
    pad_to,
    truncate,
)
from icdspark.functions.maths import binarize, safe_ratio, sigmoid  # noqa: F401
from icdspark.functions.dates import iso_to_date  # noqa: F401
