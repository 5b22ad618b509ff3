"""lodestone: a PySpark-native engine for catalogue analytics and corpus preparation."""
