"""Fixed schemas of the formats."""

#: Fixed values of the formats.
BAM = "readName string, flags int not null, referenceName string, start bigint, mappingQuality int, cigar string, mateReferenceName string, mateStart bigint, insertSize int, sequence string, baseQualities string, attributes map<string,string>, start0 bigint"
SAM_NAMES = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "attributes", "start0"]
VCF = "chrom string not null, pos int not null, id string, ref string not null, alt array<string>, qual double, filter string, info map<string,string> not null, format string, genotypes map<string,string>"
BED = "chrom string not null, chromStart bigint not null, chromEnd bigint not null, name string, score int, strand string, thickStart bigint, thickEnd bigint, itemRgb string, blockCount int, blockSizes string, blockStarts string"
FASTA = "name string not null, sequence string not null, length bigint not null"
FASTQ = "readName string not null, sequence string not null, baseQualities string not null, description string, readNumber int"
