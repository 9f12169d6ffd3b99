from .text import tokenize, shingles, jaccard
from .hashing import (md5_u64, sha_row_index, affine_index, affine_sign, affine_family,
                      minhash_family, band_bucket, poly_hash, bounded_broadcast)

__all__ = ["tokenize", "shingles", "jaccard", "md5_u64", "sha_row_index", "affine_index",
           "affine_sign", "affine_family", "minhash_family", "band_bucket", "poly_hash",
           "bounded_broadcast"]
