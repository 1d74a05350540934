"""Stand-in inputs derived from the star-schema test tables.

There are four samples, by order key; each has its own taxa, since odd and even taxids never meet in
one. Each view is one SQL text with the same rows in Spark and in DuckDB. A text names the
views and tables it reads; ``with_views`` inlines the views as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "fx_contigs": """
select concat('c', cast(p_partkey as string)) as accession, p_partkey as contig_no,
       concat('g', cast(p_partkey % 50 as string)) as genome,
       case when p_partkey % 50 < 10 then 2000 + (p_partkey * 37) % 5000
            else 20000 + (p_partkey * 7919) % 40000 end as contig_length
from part
union all
select concat('x', cast(s_suppkey as string)), 10000000 + s_suppkey, concat('h', cast(s_suppkey % 7 as string)),
       1000 + s_suppkey % 100 from supplier""",
    "fx_genomes": """
select distinct concat('g', cast(p_partkey % 50 as string)) as genome,
       cast(1000 + p_partkey % 50 as int) as id from part""",
    "fx_nodes": """
select distinct cast(1000 + p_partkey % 50 as int) as id,
       concat(case when p_partkey % 50 in (13, 26) then 'Othera' when p_partkey % 10 = 9 then 'Homo'
                   else concat('Genus', cast(p_partkey % 10 as string)) end,
              ' sp', cast(p_partkey % 50 as string)) as name from part
union all
select distinct cast(case when p_partkey % 10 = 9 then 9605 else 100 + p_partkey % 10 end as int) as id,
       case when p_partkey % 10 = 9 then 'Homo' else concat('Genus', cast(p_partkey % 10 as string)) end
       as name from part""",
    # Depth differs by genome; rows beyond a genome's depth all go to genomes 30, 31 and 41,
    # so each of these holds about a third of all rows.
    "fx_alignments": """
select b.sample, b.read, b.flag, case when b.flag = 4 then '*' else c.accession end as accession,
       case when b.flag = 4 then 0 else 1 + b.raw_pos % c.contig_length end as start_position,
       b.kraken_genus_taxid, b.line_no
from (select concat('s', cast(l_orderkey % 4 as string)) as sample,
             concat('r', cast(l_orderkey as string), '.', cast(l_linenumber % 3 as string)) as read,
             case when l_returnflag = 'A' then 0 when l_returnflag = 'R' then 16
                  when l_linestatus = 'O' then 256 else 4 end as flag,
             case when surplus then (case when l_partkey < 50 then 50 else l_partkey - l_partkey % 50 end)
                                    + (case l_suppkey % 3 when 0 then 30 when 1 then 31 else 41 end) - 50
                  when l_partkey % 50 in (12, 24, 37) then l_partkey % 50 + 50 else l_partkey end as contig_no,
             l_orderkey * 31 + l_linenumber * 977 as raw_pos,
             case when surplus then (case l_suppkey % 3 when 0 then '100' else '101' end)
                  when l_partkey % 10 = 9 then '9605'
                  when l_suppkey % 7 = 0 and l_partkey % 50 % 3 = 0
                  then cast(100 + (l_partkey % 10 + 1) % 9 as string)
                  else cast(100 + l_partkey % 10 as string) end as kraken_genus_taxid,
             ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey as line_no
      from (select *, l_orderkey % (1 + ((l_partkey % 50) * (l_partkey % 50)) % 60) <> 0 as surplus
            from lineitem) l) b
join fx_contigs c on c.contig_no = b.contig_no""",
    "fx_assignments": """
select concat('s', cast(o_orderkey % 4 as string)) as sample, case when o_orderkey % 11 = 0 then 'U' else 'C' end as status,
       concat('r', cast(o_orderkey as string), case when o_orderkey % 5 = 2 then '/1' else '' end) as read_id,
       cast(case when o_orderkey % 11 = 0 then 0 when o_orderkey % 17 = 3 then 3 when o_orderkey % 17 = 4 then 4
                 when o_orderkey % 7 = 0 then (case when o_orderkey % 10 = 9 then 9605 else 100 + o_orderkey % 10 end)
                 else 1000 + o_orderkey % 50 end as int) as taxid, o_orderkey as line_no
from orders""",
    "fx_reads": """
select concat('s', cast(o_orderkey % 4 as string)) as sample, concat('r', cast(o_orderkey as string), case when o_orderkey % 3 = 0 then '/1' else '' end) as id,
       translate(md5(cast(o_orderkey as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq from orders""",
    "fx_mates": """
select sample, 1 as mate, id, seq from fx_reads
union all
select sample, 2 as mate, replace(id, '/1', '/2') as id, reverse(seq) as seq from fx_reads""",
    "fx_taxa": """
select 1 as taxid, 0 as parent_taxid, 'R' as tax_rank, 0 as level_num, cast(1 as bigint) as line_no, 'root' as name
union all select 2, 1, 'D', 1, 2, 'Bacteria'
union all select 3, 2, '-', 2, 63, 'group'
union all select 4, 2, 'D1', 2, 64, 'subdomain'
union all select distinct cast(case when p_partkey % 10 = 9 then 9605 else 100 + p_partkey % 10 end as int), 2, 'G', 2,
       3 + (p_partkey % 10) * 6,
       case when p_partkey % 10 = 9 then 'Homo' else concat('Genus', cast(p_partkey % 10 as string)) end from part
union all select distinct cast(1000 + p_partkey % 50 as int),
       cast(case when p_partkey % 10 = 9 then 9605 else 100 + p_partkey % 10 end as int), 'S', 3,
       3 + (p_partkey % 10) * 6 + 1 + cast(floor((p_partkey % 50) / 10.0) as bigint),
       concat('sp', cast(p_partkey % 50 as string)) from part""",
    "fx_taxon_reads": """
select sample, taxid, count(*) as n from fx_assignments where taxid <> 0 group by sample, taxid""",
    "fx_report": """
select c.sample, t.line_no, t.level_num, t.tax_rank, t.taxid, t.name, c.clade_reads, c.taxon_reads,
       c.clade_reads * 10 as n_kmers, c.clade_reads * (6 + t.taxid % 5) as n_unique_kmers
from fx_taxa t
join (select sample, clade, cast(sum(n) as bigint) as clade_reads,
             cast(sum(case when taxid = clade then n else 0 end) as bigint) as taxon_reads
      from (select sample, taxid as clade, taxid, n from fx_taxon_reads
            union all select sample, 1, taxid, n from fx_taxon_reads
            union all select sample, 2, taxid, n from fx_taxon_reads
            union all select sample, case when taxid % 10 = 9 then 9605 else 100 + taxid % 10 end, taxid, n
                      from fx_taxon_reads where taxid >= 1000 and taxid <> 9605) u
      group by sample, clade) c on c.clade = t.taxid""",
    "fx_headers": """
select concat('/db/', genome, case contig_no % 5 when 0 then '.1_ASM7v1_genomic.fna' when 1 then '_Viral_x.fna'
              when 2 then '_Genome_1.fna.gz' when 3 then '_GRCh38.p13.fna' else '_genomic.fna' end) as path,
       concat(accession, ' strain x:', cast(contig_no as string)) as header, contig_no from fx_contigs""",
    "fx_assignment_lines": """
select concat(status, chr(9), read_id, chr(9),
              case when taxid = 0 then 'unclassified' else concat('t', cast(taxid as string)) end,
              ' (taxid ', cast(taxid as string), ')', chr(9), '32', chr(9), '0:1') as line, line_no, sample
from fx_assignments""",
    "fx_report_lines": """
select concat('  1.00', chr(9), cast(clade_reads as string), chr(9), cast(taxon_reads as string), chr(9),
              cast(n_kmers as string), chr(9), cast(n_unique_kmers as string), chr(9), tax_rank, chr(9),
              cast(taxid as string), chr(9), rpad('', 2 * level_num, ' '), name) as line, line_no, sample
from fx_report""",
    "fx_alignment_lines": """
select sample, kraken_genus_taxid, line_no,
       concat(read, chr(9), cast(flag as string), chr(9), accession, chr(9), cast(start_position as string),
              chr(9), '44', chr(9), '32M', chr(9), '*', chr(9), '0', chr(9), '0', chr(9), 'ACGT', chr(9), 'IIII') as line
from fx_alignments""",
    "fx_contig_seq": """
select accession, genome, contig_no,
       concat(translate(md5(concat('a', cast(contig_no % 10 as string))), '0123456789abcdef', 'ACGTACGTACGTACGT'),
              translate(md5(concat('b', cast(contig_no as string))), '0123456789abcdef', 'ACGTACGTACGTACGT')) as seq
from fx_contigs""",
    # contigs of the stated length: their 64 letters again and again
    "fx_genome_seq": """
select s.accession, s.genome, s.contig_no, c.contig_length,
       substring(repeat(s.seq, cast(floor(c.contig_length / 64.0) as int) + 1), 1, cast(c.contig_length as int)) as seq
from fx_contig_seq s join fx_contigs c on c.accession = s.accession""",
    "fx_kmer_reads": """
select concat('s', cast(l.l_orderkey % 4 as string)) as sample, concat('q', cast(l.l_orderkey as string), '.', cast(l.l_linenumber as string)) as id,
       case when l.l_orderkey % 13 = 0 then repeat('N', 40)
            else substring(s.seq, cast(1 + l.l_linenumber * 3 as int), 40) end as seq
from lineitem l join fx_contig_seq s on s.accession = concat('c', cast(l.l_partkey as string))""",
    "fx_event_points": """
select user_id as entity, event_type as grp,
       cast(floor((hour(ts) * 60 + minute(ts)) + (day(ts) - 1) * 1440) as bigint) as position from events""",
}

_NAME = re.compile(r"\b(fx_[a-z_]+)\b")


def needed_views(sql: str, extra: dict[str, str] | None = None) -> list[str]:
    """Views a text reads, directly or through others, each after those it reads."""
    views = {**VIEWS, **(extra or {})}
    pattern = re.compile(r"\b(" + "|".join(sorted(views, key=len, reverse=True)) + r")\b")
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(pattern.findall(text)):
            if name not in order:
                visit(views[name])
                order.append(name)

    visit(sql)
    return order


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` with the views it reads in a WITH clause."""
    views = {**VIEWS, **(extra or {})}
    names = needed_views(sql, extra)
    if not names:
        return sql.strip()
    parts = ",\n".join(f"{n} as (\n{views[n].strip()}\n)" for n in names)
    return f"with {parts}\n{sql.strip()}"


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A stand-in view as a DataFrame over the parquet tables of ``sf_dir``."""
    sql = with_views(f"select * from {view}")
    used = {}
    for table in TABLES:
        text, n = re.subn(rf"\b(from|join) {table}\b", rf"\1 {{{table}}}", sql)
        if n:
            sql, used[table] = text, spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql, **used)

