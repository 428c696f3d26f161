"""Readers, writers and proxy views."""

from icdspark.sources.files import (  # noqa: F401
    infer_view_name,
    read_code_dictionary,
    read_csv_table,
    read_label_list,
    read_text_dictionary,
    read_word_vectors,
    write_table,
    write_word_vectors,
)
from icdspark.sources.proxy import ProxyTables  # noqa: F401
