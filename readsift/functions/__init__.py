"""Column expressions shared by the operators."""

from readsift.functions.text import (
    first_word,
    genome_of_path,
    id_base,
    int_or_null,
    label,
    taxid_of,
)

__all__ = ["first_word", "genome_of_path", "id_base", "int_or_null", "label", "taxid_of"]
