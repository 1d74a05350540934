"""The column names of the written tables."""

# Header names of the written tables.
TABLE_HEADERS = {
    "clade_reads": "cladeReads",
    "taxon_reads": "taxonReads",
    "tax_rank": "taxRank",
    "indicator": "Indicator",
    "same": "Same",
    "different": "Different",
}
