"""Writers. Those for streams are functions (batch_df, batch_id) for `foreachBatch`."""
