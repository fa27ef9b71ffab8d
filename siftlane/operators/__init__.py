"""siftlane.operators"""
