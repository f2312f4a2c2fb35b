"""moodtick: Spark-native price/sentiment stream correlation."""
