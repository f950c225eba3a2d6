"""tagloom: Spark-native building and auditing of HTML-to-JSON training corpora."""
