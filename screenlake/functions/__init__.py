from screenlake.functions.hashing import hash_bucket, hash_unit, hex_prefix, keyhash
from screenlake.functions.scores import clip_score, is_missing, nan_to_null, threshold_class

__all__ = ["hash_bucket", "hash_unit", "hex_prefix", "keyhash", "clip_score",
           "is_missing", "nan_to_null", "threshold_class"]
