"""The registered queries as plain SQL over the test tables.

Results are common table expressions that build on each other and on the stand-in views.
"""

from __future__ import annotations

from checks.queries import EVENT_WIDTH, FILES_MAX_READS, K, MAX_READS, TAXIDS
from readsift.fixtures import with_views

_TAXIDS = ", ".join(map(str, TAXIDS))

LADDER_SQL = """case when {n} <= 65 then {r}
     when {s} < 10 then case when {m} > 1 then 'FP' else 'TP' end
     when {s} < 20 then case when {m} > 2 then 'FP' else 'TP' end
     when {s} < 40 then case when {m} > 3 then 'FP' else 'TP' end
     when {s} < 80 then case when {m} > 4 then 'FP' else 'TP' end
     when {s} < 120 then case when {m} > 6 then 'FP' else 'TP' end
     when {s} < 160 then case when {m} > 8 then 'FP' else 'TP' end
     when {s} < 200 then case when {m} > 10 then 'FP' else 'TP' end
     when {s} < 240 then case when {m} > 12 then 'FP' else 'TP' end
     when {s} < 280 then case when {m} > 14 then 'FP' else 'TP' end
     when {s} < 320 then case when {m} > 15 then 'FP' else 'TP' end
     else {r} end""".format(
    n="n_windows",
    s="reads_tot",
    m="reads_max",
    r="(case when reads_tot = 0 then null when cast(reads_max as double) / reads_tot < 0.08 then 'TP' else 'FP' end)",
)

_BASE = "case when suffix(id, '/1') or suffix(id, '/2') then left(id, length(id) - 2) else id end"


def _index_of(kmers: str) -> str:
    """Each k-mer with the deepest taxon above all taxa that hold it."""
    return f"""
select kmer, cast(max_by(ancestor, depth) as int) as taxid from
 (select k.kmer, t.ancestor, t.depth, count(*) as covered, any_value(n.taxa) as taxa
  from {kmers} k join o_database t on t.descendant = k.taxid
  join (select kmer, count(*) as taxa from {kmers} group by kmer) n on n.kmer = k.kmer
  group by k.kmer, t.ancestor, t.depth)
where covered = taxa group by kmer"""


PARTS: dict[str, str] = {
    "o_mapped": "select * from fx_alignments where flag <> 4",
    "o_taxonomy": """
select c.accession, c.genome, g.id, n.name from fx_contigs c
left join fx_genomes g on g.genome is not distinct from c.genome
left join fx_nodes n on n.id = g.id""",
    "o_annotated": """
select m.*, t.genome, t.id, t.name from o_mapped m left join o_taxonomy t using (accession)""",
    "o_hits": """
select sample, kraken_genus_taxid, accession, genome, id, name, count(*) as mapped,
       count(*) filter (where flag in (0, 16)) as "primary"
from o_annotated group by all""",
    "o_pairs": """
select distinct sample, genome, kraken_genus_taxid from o_annotated where flag in (0, 16)""",
    "o_offsets": """
select accession, genome, contig_length, contig_no, end_pos - contig_length as start_pos, end_pos
from (select *, cast(sum(contig_length + 1) over (partition by genome order by contig_no
             rows between unbounded preceding and current row) as bigint) as end_pos from fx_contigs)""",
    "o_first": """
select * exclude (rn) from
  (select *, row_number() over (partition by sample, read order by kraken_genus_taxid, line_no) as rn from o_mapped)
where rn = 1""",
    "o_placed": """
select f.sample, f.read, f.kraken_genus_taxid, f.accession, f.start_position, p.genome, o.start_pos,
       f.start_position + o.start_pos as start_genome
from o_first f
left join fx_contigs c on c.accession = f.accession
left join o_pairs p on p.genome = c.genome and p.kraken_genus_taxid = f.kraken_genus_taxid and p.sample = f.sample
left join o_offsets o on o.accession = f.accession and o.genome = p.genome""",
    "o_counts": """
select sample, genome, kraken_genus_taxid, cast(floor(start_genome / 8000) as bigint) + 1 as "window", count(*) as reads
from o_placed where start_genome is not null group by all""",
    "o_sizes": """
select p.sample, p.genome, p.kraken_genus_taxid, max(o.end_pos) as size,
       cast(floor(max(o.end_pos) / 8000) as bigint) + 1 as n_windows
from o_pairs p join o_offsets o on o.genome = p.genome group by all""",
    "o_grid": """
select sample, genome, kraken_genus_taxid, unnest(range(1, n_windows + 1)) as "window" from o_sizes""",
    "o_windows": """
select g.*, coalesce(c.reads, 0) as reads from o_grid g
left join o_counts c using (sample, genome, kraken_genus_taxid, "window")""",
    "o_totals": """
select sample, genome, kraken_genus_taxid, max("window") as n_windows, cast(sum(reads) as bigint) as reads_tot,
       max(reads) as reads_max from o_windows group by all""",
    "o_best": """
select * from o_totals t where reads_tot =
  (select max(reads_tot) from o_totals u where u.sample = t.sample and u.kraken_genus_taxid = t.kraken_genus_taxid)""",
    "o_coverage": f"select *, {LADDER_SQL} as indicator from o_best",
    "o_genera": """
select sample, line_no, tax_rank, name, clade_reads, taxon_reads, n_kmers, n_unique_kmers,
       cast(taxid as varchar) as kraken_genus_taxid
from fx_report where tax_rank = 'G' and name <> 'Homo' and clade_reads > 3""",
    "o_taxverdict": """
select *, case when percent_agreement > 0.8 then 'TP' else 'FP' end as tax_indicator from
 (select *, cast(same as double) / (same + different) as percent_agreement from
  (select a.sample, a.kraken_genus_taxid,
          count(*) filter (where split_part(a.name, ' ', 1) = g.name) as same,
          count(*) filter (where split_part(a.name, ' ', 1) <> g.name) as different
   from o_annotated a left join o_genera g
     on g.sample = a.sample and g.kraken_genus_taxid = a.kraken_genus_taxid
   where a.flag in (0, 16) group by all having count(*) > 3)
  where same + different > 0)""",
    "o_refined": """
select *, concat('<i style=''color:', coalesce(tick_color, 'NA'), '''>', name, '</i>') as tick_name from
 (select g.*, c.genome, c.reads_tot, c.indicator, t.same, t.different, t.percent_agreement, t.tax_indicator,
         case when c.indicator = 'FP' or t.tax_indicator = 'FP' then 'red'
              when c.indicator = 'TP' or t.tax_indicator = 'TP' then 'darkgreen' end as tick_color
  from o_genera g join o_coverage c using (sample, kraken_genus_taxid)
  left join o_taxverdict t using (sample, kraken_genus_taxid)
  where c.indicator is not null
  qualify row_number() over (partition by g.sample, g.name order by g.line_no, c.genome) = 1)""",
    "o_uniqued": """
select *, concat('<i style=''color:', coalesce(tick_color, 'NA'), '''>', name, '</i>') as tick_name from
 (select *, case indicator when 'TP' then 'darkgreen' when 'FP' then 'red' end as tick_color from
  (select *, case when n_kmers = 0 then null when cast(n_unique_kmers as double) / n_kmers < 0.8 then 'FP' else 'TP' end
     as indicator from o_genera))""",
    "o_species": """
select s.*, n.name as genera from
 (select sample, kraken_genus_taxid, name, count(*) as n from o_annotated
  where (sample, kraken_genus_taxid) in (select sample, kraken_genus_taxid from o_refined where tick_color = 'darkgreen')
  group by all) s
left join fx_nodes n on cast(n.id as varchar) = s.kraken_genus_taxid
qualify rank() over (partition by s.sample, s.kraken_genus_taxid order by s.n desc) <= 15""",
    "o_profile": """
select w.sample, w.genome, w.kraken_genus_taxid, w."window", w.reads, n.name from o_windows w
join o_coverage c using (sample, genome, kraken_genus_taxid)
left join fx_nodes n on cast(n.id as varchar) = w.kraken_genus_taxid""",
    # tree: parents are part of the stand-in taxonomy, so no pre-order logic is needed here
    "o_database": """
select taxid as descendant, taxid as ancestor, level_num as depth from fx_taxa
union all select taxid, parent_taxid, level_num - 1 from fx_taxa where parent_taxid > 0
union all select t.taxid, p.parent_taxid, t.level_num - 2 from fx_taxa t join fx_taxa p on p.taxid = t.parent_taxid
  where p.parent_taxid > 0
union all select t.taxid, 1, 0 from fx_taxa t where t.level_num = 3""",
    "o_tree": """
select r.sample, d.descendant, d.ancestor, d.depth from o_database d join fx_report r on r.taxid = d.descendant""",
    "o_samples": "select distinct sample from fx_assignments",
    "o_wanted": f"select unnest([{_TAXIDS}]) as target",
    "o_children": """
select sample, descendant as taxid from o_tree join o_wanted on ancestor = target
union select sample, target from o_wanted, o_samples""",
    "o_family": """
select sample, taxid from o_children union select sample, ancestor from o_tree join o_wanted on descendant = target""",
    "o_ids": """
select distinct sample, read_id from fx_assignments where (sample, taxid) in (select sample, taxid from o_children)""",
    "o_targets": "select sample, taxid from fx_report where tax_rank = 'G' and taxid <> 9605",
    "o_genus_ids": """
select distinct a.sample, a.read_id, t.ancestor as target from fx_assignments a
join o_tree t on t.sample = a.sample and t.descendant = a.taxid
join o_targets g on g.sample = t.sample and g.taxid = t.ancestor""",
    "o_species_kmers": f"""
select distinct k.kmer, g.id as taxid from
 (select genome, least(f, reverse(translate(f, 'ACGT', 'TGCA'))) as kmer from
   (select genome, substring(seq, cast(i as int), {K}) as f
    from (select genome, seq, unnest(range(1, length(seq) - {K} + 2)) as i from fx_contig_seq))) k
join fx_genomes g using (genome)""",
    # contigs repeat their 64 letters, and the shortest repeats them many times
    "o_genome_kmers": f"""
select distinct k.kmer, g.id as taxid from
 (select genome, least(f, reverse(translate(f, 'ACGT', 'TGCA'))) as kmer from
   (select genome, substring(concat(seq, seq), cast(i as int), {K}) as f
    from (select genome, seq, unnest(range(1, 65)) as i from fx_contig_seq))) k
join fx_genomes g using (genome)""",
    "o_index": _index_of("o_species_kmers"),
    "o_genome_index": _index_of("o_genome_kmers"),
    "o_read_kmers": f"""
select sample, id, case when regexp_matches(f, '^[ACGT]+$') then least(f, reverse(translate(f, 'ACGT', 'TGCA'))) end as kmer
from (select sample, id, substring(seq, cast(i as int), {K}) as f
      from (select sample, id, seq, unnest(range(1, length(seq) - {K} + 2)) as i from fx_kmer_reads))""",
    "o_found": """
select r.sample, r.id, r.kmer, x.taxid from o_read_kmers r left join o_index x on x.kmer = r.kmer""",
    "o_valid": "select sample, id, count(kmer) as n_kmers from o_found group by all",
    "o_own": "select sample, id, taxid, count(*) as hits from o_found where taxid is not null group by all",
    "o_clades": """
select o.sample, o.id, t.ancestor, t.depth, sum(o.hits) as clade
from o_own o join o_database t on t.descendant = o.taxid group by all""",
    "o_scores": """
select o.sample, o.id, o.taxid, sum(a.hits) as score
from o_own o join o_database t on t.descendant = o.taxid
join o_own a on a.sample = o.sample and a.id = o.id and a.taxid = t.ancestor group by all""",
    "o_ties": """
select * from o_scores qualify score = max(score) over (partition by sample, id)""",
    "o_common": """
select x.sample, x.id, t.ancestor from o_ties x join o_database t on t.descendant = x.taxid
join (select sample, id, count(*) as n from o_ties group by all) c on c.sample = x.sample and c.id = x.id
group by x.sample, x.id, t.ancestor having count(*) = any_value(c.n)""",
    "o_calls": """
select c.sample, c.id, max_by(c.ancestor, k.depth) as taxid
from o_common c
join o_clades k on k.sample = c.sample and k.id = c.id and k.ancestor = c.ancestor
join o_valid v on v.sample = c.sample and v.id = c.id
where cast(k.clade as double) / v.n_kmers >= 0.2 group by all""",
    "o_classified": """
select v.sample, v.id, cast(coalesce(c.taxid, 0) as int) as taxid, v.n_kmers
from o_valid v left join o_calls c on c.sample = v.sample and c.id = v.id""",
}

_READS_BY_ID = f"""
select sample, id, seq from fx_reads
where (sample, id) in (select sample, read_id from {{ids}})
   or (sample, {_BASE}) in (select sample, read_id from {{ids}})"""

_SUMMARY = f"""
select sample, (select count(*) from o_children c where c.sample = s.sample) as taxids,
       (select count(*) from fx_assignments a where a.sample = s.sample) as assignments,
       (select count(*) from o_ids i where i.sample = s.sample) as ids,
       (select count(*) from ({_READS_BY_ID.format(ids="o_ids")}) r where r.sample = s.sample) as reads
from o_samples s"""

_EVENT_COUNTS = f"""
select entity, grp, cast(floor(position / {EVENT_WIDTH}) as bigint) + 1 as "window", count(*) as reads
from fx_event_points group by all"""

SQL: dict[str, str] = {
    "read_sequences": """
select sample, mate, id, concat(id, ' read of ', sample) as description, seq from fx_mates""",
    "read_fastq": """
select sample, id, concat(id, ' x') as description, seq, repeat('@', length(seq)) as qual from fx_reads""",
    "read_genomes": "select accession as id, concat(accession, ' contig of ', genome) as description, seq from fx_contig_seq",
    "read_assignments": "select sample, status, read_id, taxid, '32' as length, '0:1' as hits from fx_assignments",
    "report_levels": "select sample, taxid, level_num, tax_rank from fx_report",
    "report_table": """
select sample, cast(1.0 as double) as percentage, clade_reads, taxon_reads, n_kmers, n_unique_kmers, tax_rank, taxid, name,
       level_num from fx_report""",
    "read_alignments": """
select sample, read, flag, accession, start_position, cast(44 as int) as mapq, '32M' as cigar, kraken_genus_taxid
from o_mapped""",
    "read_dimension": "select accession, nullif(genome, 'h3') as genome, contig_length, contig_no from fx_contigs",
    "contig_offsets_from_files": "select * from o_offsets",
    "read_taxon_list": "select * from o_targets",
    "list_samples": "select distinct sample from fx_alignments",
    "read_genome_chunks": """
select accession as id, concat(accession, ' contig of ', genome) as description, length(seq) as n_letters, md5(seq) as seq_md5,
       true as cut from fx_genome_seq""",
    "contig_lengths": "select accession, contig_length from fx_contigs",
    "contig_headers": """
select path, header, regexp_replace(header, '[:>]+', chr(9), 'g') as fields from fx_headers""",
    "contig_genome": """
select split_part(header, ' ', 1) as accession,
       split_part(split_part(split_part(split_part(split_part(split_part(replace(path, '/db/', ''),
         '.fna', 1), '_genomic', 1), '_ASM', 1), '_Viral', 1), '_Genome', 1), '_GRCh38', 1) as genome from fx_headers""",
    "read_lengths": "select id as description, length(seq) as length from fx_reads",
    "contig_taxonomy": "select * from o_taxonomy",
    "contig_offsets": "select * from o_offsets",
    "target_genera": "select sample, taxid from fx_report where tax_rank = 'G' and taxid <> 9605",
    "genus_report": "select * from o_genera",
    "annotate_alignments": "select * from o_annotated",
    "alignment_hits": "select * from o_hits",
    "primary_pairs": "select * from o_pairs",
    "genomes_hit": "select accession, genome from fx_contigs where genome in (select genome from o_pairs)",
    "pair_contigs": """
select c.accession, c.genome, p.sample, p.kraken_genus_taxid from fx_contigs c
left join o_pairs p on p.genome is not distinct from c.genome""",
    "first_alignment": "select * from o_first",
    "first_alignment_files": "select * exclude (line_no) from o_first",
    "report_edges": """
select r.sample, t.taxid, case when t.parent_taxid > 0 then t.parent_taxid end as parent_taxid, t.level_num, t.line_no
from fx_taxa t join fx_report r on r.taxid = t.taxid""",
    "level_ids": """
select sample, taxid, level_num, case when taxid in (3, 4) then 'D1' else tax_rank end as level_id from fx_report""",
    "ancestors": """
select sample, target, ancestor as taxid from o_tree join o_wanted on descendant = target
union select sample, target, target from o_wanted, o_samples""",
    "descendants": """
select sample, target, descendant as taxid from o_tree join o_wanted on ancestor = target
union select sample, target, target from o_wanted, o_samples""",
    "extract_reads": _READS_BY_ID.format(ids="o_ids"),
    "extract_parents": _READS_BY_ID.format(
        ids="(select sample, read_id from fx_assignments where (sample, taxid) in (select sample, taxid from o_family))"
    ),
    "extract_exclude": _READS_BY_ID.format(
        ids="(select sample, read_id from fx_assignments where (sample, taxid) not in (select sample, taxid from o_children))"
    ),
    "extract_max": _READS_BY_ID.format(
        ids=f"""(select sample, read_id from fx_assignments where (sample, taxid) in (select sample, taxid from o_children)
                 group by sample, read_id
                 qualify row_number() over (partition by sample order by min(line_no)) <= {MAX_READS})"""
    ),
    "extract_max_files": _READS_BY_ID.format(
        ids=f"""(select sample, read_id from fx_assignments where (sample, taxid) in (select sample, taxid from o_children)
                 group by sample, read_id
                 qualify row_number() over (partition by sample order by min(line_no)) <= {FILES_MAX_READS})"""
    ),
    "extract_paired": f"""
select sample, mate, id, seq from fx_mates
where (sample, id) in (select sample, read_id from o_ids) or (sample, {_BASE}) in (select sample, read_id from o_ids)""",
    "extract_paired_files": f"""
select sample, mate, id, seq from fx_mates
where (sample, id) in (select sample, read_id from o_ids) or (sample, {_BASE}) in (select sample, read_id from o_ids)""",
    "extract_all_genera": f"""
select a.target, r.sample, r.id, r.seq from fx_reads r
join o_genus_ids a on a.sample = r.sample and a.read_id = r.id
union select a.target, r.sample, r.id, r.seq from (select *, {_BASE} as base from fx_reads) r
join o_genus_ids a on a.sample = r.sample and a.read_id = r.base""",
    "taxon_counts": """
select sample, taxid, count(*) as n from fx_assignments
where (sample, taxid) in (select sample, taxid from o_children) group by all""",
    "extract_summary": _SUMMARY,
    "written_summary": _SUMMARY,
    "place_reads": "select * from o_placed",
    "window_counts": "select * from o_counts",
    "genome_sizes": "select * from o_sizes",
    "coverage_totals": "select * from o_totals",
    "best_genome": "select * from o_best",
    "coverage_verdict": "select * from o_coverage",
    "coverage_profile": "select * from o_profile",
    "sorted_profile": """
select *, row_number() over (partition by sample order by genome, kraken_genus_taxid, "window") as position from o_profile""",
    "sorted_species": """
select *, row_number() over (partition by sample order by n, kraken_genus_taxid, name nulls last) as position from o_species""",
    "event_window_counts": _EVENT_COUNTS,
    "event_coverage_verdict": f"""
select *, {LADDER_SQL} as indicator from
 (select entity, grp, max("window") as n_windows, cast(sum(reads) as bigint) as reads_tot, max(reads) as reads_max
  from ({_EVENT_COUNTS}) group by entity, grp)
qualify reads_tot = max(reads_tot) over (partition by entity)""",
    "event_coverage_profile": f"""
select g.grp, g."window", coalesce(c.reads, 0) as reads from
 (select grp, unnest(range(1, cast(floor(max(position) / {EVENT_WIDTH}) as bigint) + 2)) as "window"
  from fx_event_points group by grp) g
left join (select grp, cast(floor(position / {EVENT_WIDTH}) as bigint) + 1 as "window", count(*) as reads
           from fx_event_points group by all) c on c.grp = g.grp and c."window" = g."window\"""",
    "write_table": "select sample, kraken_genus_taxid, name, n, genera from o_species",
    "taxonomy_verdict": "select * from o_taxverdict",
    "refine_report": "select * from o_refined",
    "unique_kmer_verdict": "select * from o_uniqued",
    "species_top": "select * from o_species",
    "compare_groupings": """
select 'original' as panel, sample, kraken_genus_taxid, name, clade_reads, 'black' as tick_color,
       concat('<i style=''color:black''>', name, '</i>') as tick_name from o_genera
union all select 'refined', sample, kraken_genus_taxid, name, clade_reads, tick_color, tick_name from o_refined
union all select 'unique', sample, kraken_genus_taxid, name, clade_reads, tick_color, tick_name from o_uniqued""",
    "clade_report": """
select r.sample, r.taxid, r.clade_reads, r.taxon_reads, 100.0::double * r.clade_reads / t.n as percentage
from fx_report r join (select sample, count(*) as n from fx_assignments group by sample) t on t.sample = r.sample""",
    "kmer_index": "select kmer, taxid from o_genome_index",
    "classify_reads": "select * from o_classified",
    "clade_kmers_estimated": """
select f.sample, t.ancestor as taxid, count(*) as n_kmers, count(distinct f.kmer) as n_unique_kmers, true as close
from o_found f join o_database t on t.descendant = f.taxid group by all""",
    "clade_report_kmers": """
select r.sample, r.taxid, r.clade_reads, r.taxon_reads, coalesce(k.n_kmers, 0) as n_kmers,
       coalesce(k.n_unique_kmers, 0) as n_unique_kmers
from (select c.sample, t.ancestor as taxid, count(*) as clade_reads,
             count(*) filter (where t.ancestor = c.taxid) as taxon_reads
      from o_classified c join o_database t on t.descendant = c.taxid group by all) r
left join (select f.sample, t.ancestor as taxid, count(*) as n_kmers, count(distinct f.kmer) as n_unique_kmers
           from o_found f join o_database t on t.descendant = f.taxid group by all) k
  on k.sample = r.sample and k.taxid = r.taxid""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, PARTS) for name, sql in SQL.items()}
