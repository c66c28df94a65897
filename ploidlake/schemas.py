"""Column types of the tables that have no header or no types of their own."""

PAF = "query_id string, query_len bigint, query_start bigint, query_end bigint, strand string, target_id string, target_len bigint, target_start bigint, target_end bigint, match_len bigint, block_len bigint, mapq int, tp string, cigar string, line_no bigint"
DEPTH = "contig_id string, win_start bigint, win_end bigint, win_len bigint, covered_site bigint, total_depth bigint, coverage double, depth double"
CONTIG_TYPES = "contig_id string, average_depth double, contig_type string"
DISTANCES = "seq1 string, seq2 string, dist double, pvalue double, shared_hashes string"
LINKS = "ctg_i string, ctg_j string, links bigint"
READ_PAIRS = "read_name string, flag int, ref string, pos bigint, mref string, mpos bigint"
